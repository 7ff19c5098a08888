"""Figures of the monthly query budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.rounding import rounded

MIB = 1024**2
GIB = 1024**3
TIB = 1024**4

# Default budget.
FREE_TIER_BYTES = 1099511627776
OPERATIONAL_LIMIT_PCT = 50.0
MAX_BYTES_PER_QUERY = 10737418240
USD_PER_TIB = 6.25

# Alert levels by percent of the free tier, highest first.
BLOCKED_LEVEL = "BLOQUEIO_OPERACIONAL"
ALERT_TIERS = ((40.0, "ALERTA_CRITICO"), (25.0, "ALERTA"), (10.0, "ACOMPANHAMENTO"))
CALM_LEVEL = "NORMAL"

# Verdicts on a query that asks to run.
ADMITTED = "ADMITTED"
TOO_LARGE = "TOO_LARGE"
CIRCUIT_BREAKER = "CIRCUIT_BREAKER"


@dataclass(frozen=True)
class Budget:
    """Monthly limits; a missing or zero limit falls back to its default."""

    free_tier_bytes: int | None = None
    operational_limit_pct: float | None = None
    max_bytes_per_query: int | None = None
    usd_per_tib: float = USD_PER_TIB

    def __post_init__(self):
        object.__setattr__(self, "free_tier_bytes", self.free_tier_bytes or FREE_TIER_BYTES)
        object.__setattr__(
            self, "operational_limit_pct", self.operational_limit_pct or OPERATIONAL_LIMIT_PCT
        )
        object.__setattr__(
            self, "max_bytes_per_query", self.max_bytes_per_query or MAX_BYTES_PER_QUERY
        )

    @property
    def ceiling_bytes(self) -> int:
        return int(self.free_tier_bytes * (self.operational_limit_pct / 100.0))


def alert_level(used: Column, budget: Budget) -> Column:
    """Level of a month's usage.  The operational limit is tested before the tiers."""
    pct = used / F.lit(float(budget.free_tier_bytes)) * 100.0
    level = F.when(pct >= budget.operational_limit_pct, BLOCKED_LEVEL)
    for threshold, name in ALERT_TIERS:
        level = level.when(pct >= threshold, name)
    return level.otherwise(CALM_LEVEL)


def admission(estimate: Column, used: Column, budget: Budget) -> Column:
    """Verdict on one query, given the month's usage: first its own size, then the ceiling."""
    return (
        F.when(estimate > budget.max_bytes_per_query, TOO_LARGE)
        .when(used + estimate > budget.ceiling_bytes, CIRCUIT_BREAKER)
        .otherwise(ADMITTED)
    )


def cost_usd(billed: Column, budget: Budget) -> Column:
    return rounded(billed / F.lit(float(TIB)) * budget.usd_per_tib, 4)


def in_unit(size: Column, unit: int, decimals: int) -> Column:
    """Bytes as MiB, GiB or TiB (``unit`` bytes each)."""
    return rounded(size / F.lit(float(unit)), decimals)
