"""Exact money arithmetic.

Amounts keep nine decimals, the warehouse's numeric scale; so do quotients,
before they are rounded half-up to ``MONEY`` for display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
AMOUNT = "decimal(28,9)"
QUOTIENT = "decimal(38,9)"


def mean_money(amount: Column) -> Column:
    """Aggregate: mean amount per row, two decimals."""
    mean = (F.sum(amount) / F.count(amount)).cast(QUOTIENT)
    return F.round(mean, 2).cast(MONEY)


def mean_count(number: Column) -> Column:
    """Aggregate: mean of whole numbers, two decimals."""
    return F.round(F.avg(number), 2)


def growth_pct(value: Column, base: Column) -> Column:
    """Percent by which ``value`` exceeds ``base``; 0 without a positive base."""
    growth = ((value - base) / base).cast(QUOTIENT) * 100
    return F.round(F.when(F.coalesce(base, F.lit(0)) > 0, growth).otherwise(F.lit(0)), 2).cast(MONEY)
