"""Budget analytics over the ledger of query jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.budget import GIB, Budget, admission, alert_level, cost_usd
from tidemark.functions.dates import instant, month_label, month_start
from tidemark.functions.rounding import with_rounded
from tidemark.operators.ordered import running_total
from tidemark.operators.retention import KEPT_RECORDS, keep_last


def billed_jobs(jobs: DataFrame) -> DataFrame:
    """Finished jobs that were billed; failed ones count as well."""
    return jobs.where((F.col("state") == "DONE") & (F.coalesce("bytes_billed", F.lit(0)) != 0))


def successful_records(ledger: DataFrame) -> DataFrame:
    """Ledger records of successful jobs."""
    return ledger.where(F.col("status") == "SUCCESS")


def monthly_usage(jobs: DataFrame, status: str | None = None) -> DataFrame:
    """Bytes billed per project and month: ``project_id, month, bytes_used_month``.

    Without ``status`` all given jobs count, failed ones included; with a
    status only those that have it.  Missing bytes count as 0.
    """
    billed = F.coalesce("bytes_billed", F.lit(0))
    if status is not None:
        billed = F.when(F.col("status") == status, billed).otherwise(0)
    return jobs.groupBy("project_id", month_start(F.col("start_time")).alias("month")).agg(
        F.sum(billed).alias("bytes_used_month")
    )


def usage_of_month(
    jobs: DataFrame, now: dt.datetime, status: str | None = None, projects: DataFrame | None = None
) -> DataFrame:
    """``monthly_usage`` of the month that ``now`` lies in.

    Each of ``projects`` (column ``project_id``) has a row, with 0 bytes if it ran nothing.
    """
    since = F.date_trunc("month", instant(now))
    until = (since.cast("date") + F.expr("INTERVAL 1 MONTH")).cast("timestamp")
    used = monthly_usage(jobs.where((F.col("start_time") >= since) & (F.col("start_time") < until)), status)
    if projects is None:
        return used
    return (
        projects.select("project_id")
        .distinct()
        .join(used, "project_id", "full")
        .select(
            "project_id",
            F.coalesce("month", since.cast("date")).alias("month"),
            F.coalesce("bytes_used_month", F.lit(0)).alias("bytes_used_month"),
        )
    )


def with_alert_level(usage: DataFrame, budget: Budget) -> DataFrame:
    return usage.withColumn("alert_level", alert_level(F.col("bytes_used_month"), budget))


def usage_summary(usage: DataFrame, budget: Budget) -> DataFrame:
    """Usage against the free tier and the operational ceiling, 13 figures per project and month."""
    ceiling = budget.ceiling_bytes
    used = F.col("bytes_used_month")
    # What is used several times is a column of its own, so that no expression contains another's copies.
    left = usage.select(
        "project_id",
        month_label(F.col("month")).alias("month"),
        "bytes_used_month",
        F.greatest(F.lit(0), F.lit(ceiling) - used).alias("bytes_remaining_to_ceiling"),
        (used / F.lit(float(budget.free_tier_bytes)) * 100.0).alias("_free"),
        (used / F.lit(float(ceiling)) * 100.0 if ceiling > 0 else F.lit(0.0)).alias("_of_ceiling"),
    )
    free = with_rounded(left, pct_free_tier_used=("_free", 4))
    figures = with_rounded(
        free.select(
            "*",
            (used / F.lit(float(GIB))).alias("_used"),
            F.greatest(F.lit(0.0), 100.0 - F.col("pct_free_tier_used")).alias("_unused"),
            (F.col("bytes_remaining_to_ceiling") / F.lit(float(GIB))).alias("_left"),
        ),
        gib_used_month=("_used", 3),
        pct_free_tier_remaining=("_unused", 4),
        gib_remaining_to_ceiling=("_left", 3),
        pct_ceiling_used=("_of_ceiling", 2),
    )
    return figures.select(
        "project_id",
        "month",
        "bytes_used_month",
        "gib_used_month",
        F.lit(round(budget.free_tier_bytes / GIB, 1)).alias("free_tier_total_gib"),
        "pct_free_tier_used",
        "pct_free_tier_remaining",
        F.lit(round(ceiling / GIB, 1)).alias("operational_ceiling_gib"),
        "bytes_remaining_to_ceiling",
        "gib_remaining_to_ceiling",
        "pct_ceiling_used",
        alert_level(used, budget).alias("alert_level"),
        (used >= ceiling).alias("circuit_breaker_active"),
    )


def request_verdicts(requests: DataFrame, usage: DataFrame, budget: Budget) -> DataFrame:
    """Each request judged by itself against the usage of its project and month.

    One request's verdict does not change the next one's.  ``requests`` has
    project_id, month and estimated_bytes.
    """
    used = F.coalesce("bytes_used_month", F.lit(0))
    estimate = F.coalesce("estimated_bytes", F.lit(0))
    judged = requests.join(usage, ["project_id", "month"], "left")
    return judged.withColumn("verdict", admission(estimate, used, budget)).withColumn(
        "projected_bytes", used + estimate
    )


def job_costs(ledger: DataFrame, budget: Budget) -> DataFrame:
    """Cost of each successful record, its project's month total with it, and the alert level then.

    Totals run in the order of start time, job id and bytes, nulls first, so that a busy project's month or
    instant is spread over many tasks.  Every successful record is costed: those without a project are
    a project of their own, those without a start time a month of their own.
    """
    jobs = successful_records(ledger).select(
        "project_id",
        month_start(F.col("start_time")).alias("month"),
        "start_time",
        "job_id",
        F.coalesce("bytes_billed", F.lit(0)).alias("bytes_billed"),
    )
    placed = running_total(
        jobs, ["project_id", "month"], ["start_time", "job_id", "bytes_billed"], "bytes_billed", "month_total_after"
    )
    return placed.select(
        "project_id",
        "month",
        "job_id",
        "bytes_billed",
        cost_usd(F.col("bytes_billed"), budget).alias("estimated_cost_usd"),
        "month_total_after",
        alert_level(F.col("month_total_after"), budget).alias("alert_level"),
    )


def retained(ledger: DataFrame, rows: int = KEPT_RECORDS) -> DataFrame:
    """The newest records of each project's ledger."""
    return keep_last(ledger, ["project_id"], [F.desc("start_time"), F.desc("job_id")], rows)


def restricted_jobs(ledger: DataFrame, terms: list[str]) -> DataFrame:
    """Jobs in projects whose name contains one of ``terms``, in any case."""
    name = F.lower("project_id")
    hit = F.lit(False)
    for term in terms:
        hit = hit | name.contains(term.lower())
    return ledger.where(hit)


def require_unrestricted(ledger: DataFrame, terms: list[str]) -> DataFrame:
    """``ledger`` whose job fails on a restricted project."""
    name = F.lower("project_id")
    hit = F.lit(False)
    for term in terms:
        hit = hit | name.contains(term.lower())
    message = F.concat(F.lit("restricted project "), F.col("project_id"))
    return ledger.where(F.assert_true(~hit, message).isNull())
