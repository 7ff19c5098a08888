"""The commercial calendar: one row per day with holidays and proximity windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import is_weekend
from tidemark.operators.nearest import nearest_dates

# Default span, labels of days without a holiday, window lengths.
FIRST_DAY = dt.date(2024, 1, 1)
LAST_DAY = dt.date(2026, 12, 31)
NO_HOLIDAY_NAME = "Dia Comum"
NO_HOLIDAY_TYPE = "regular"
PRE_HOLIDAY_DAYS = (1, 7)
POST_HOLIDAY_DAYS = (1, 3)


def date_spine(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """Every day from ``first`` to ``last``, both included: ``calendar_date``."""
    days = max((last - first).days + 1, 0)
    return spark.range(0, days, 1, 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("calendar_date")
    )


def span_of(df: DataFrame, column: str) -> tuple[dt.date, dt.date]:
    """First day of the first year and last day of the last year seen in a date column."""
    low, high = df.select(F.col(column).cast("date").alias("day")).agg(F.min("day"), F.max("day")).first()
    return dt.date(low.year, 1, 1), dt.date(high.year, 12, 31)


def calendar_parts(days: DataFrame) -> DataFrame:
    """``days`` (with ``calendar_date``) plus the parts and names of each date."""
    day = F.col("calendar_date")
    return days.select(
        "*",
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        F.dayofweek(day).alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.weekofyear(day).alias("week_of_year"),
        is_weekend(day).alias("is_weekend"),
    )


def commercial_calendar(
    spark: SparkSession,
    holidays: DataFrame,
    first: dt.date = FIRST_DAY,
    last: dt.date = LAST_DAY,
    on_duplicate_date: str = "all",
) -> DataFrame:
    """The calendar from staged ``holidays``.

    A date with several holidays gets a row for each (``"all"``) or only for
    the one with the smallest ``holiday_id`` (``"first"``).

    This is a left join of the days with their holidays, written without the
    join: a holiday inside the span is a row by itself, with itself as the
    nearest holiday, and the remaining days come from the nearest-date search.
    However many holidays share a date, no task has to gather them.
    """
    if on_duplicate_date == "first":
        holidays = holidays.groupBy("holiday_date").agg(
            F.min_by("holiday_name", "holiday_id").alias("holiday_name"),
            F.min_by("holiday_type", "holiday_id").alias("holiday_type"),
        )
    elif on_duplicate_date != "all":
        raise ValueError(f"on_duplicate_date must be 'all' or 'first', not {on_duplicate_date!r}")
    near = nearest_dates(date_spine(spark, first, last), holidays.select("holiday_date"))
    other_days = near.where(~F.col("calendar_date").eqNullSafe(F.col("next_date"))).select(
        "calendar_date",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("kind"),
        "next_date",
        "prev_date",
    )
    day = F.col("holiday_date")
    holiday_days = holidays.where(day.between(F.lit(first), F.lit(last))).select(
        day.alias("calendar_date"),
        F.col("holiday_name").alias("name"),
        F.col("holiday_type").alias("kind"),
        day.alias("next_date"),
        day.alias("prev_date"),
    )
    dated = calendar_parts(other_days.unionByName(holiday_days))
    ahead = F.datediff("next_date", "calendar_date")
    behind = F.datediff("calendar_date", "prev_date")
    return dated.select(
        "calendar_date",
        "day_of_month",
        "month_number",
        "month_name",
        "quarter_number",
        "year_number",
        "day_of_week_num",
        "day_of_week_name",
        "week_of_year",
        "is_weekend",
        F.col("name").isNotNull().alias("is_holiday"),
        F.coalesce("name", F.lit(NO_HOLIDAY_NAME)).alias("holiday_name"),
        F.coalesce("kind", F.lit(NO_HOLIDAY_TYPE)).alias("holiday_type"),
        (~F.col("is_weekend") & F.col("name").isNull()).alias("is_business_day"),
        F.col("next_date").alias("next_holiday_date"),
        ahead.alias("days_to_holiday"),
        F.col("prev_date").alias("prev_holiday_date"),
        behind.alias("days_after_holiday"),
        F.coalesce(ahead.between(*PRE_HOLIDAY_DAYS), F.lit(False)).alias("is_pre_holiday_window"),
        F.coalesce(behind.between(*POST_HOLIDAY_DAYS), F.lit(False)).alias("is_post_holiday_window"),
    )


def dim_calendar(calendar: DataFrame) -> DataFrame:
    """The calendar under the names of the dimension table."""
    return calendar.select(
        F.col("calendar_date").alias("date"),
        F.col("day_of_month").alias("day"),
        F.col("month_number").alias("month"),
        "month_name",
        F.col("quarter_number").alias("quarter"),
        F.col("year_number").alias("year"),
        F.col("day_of_week_num").alias("day_of_week"),
        F.col("day_of_week_name").alias("day_name"),
        "week_of_year",
        "is_weekend",
        "is_business_day",
        "is_holiday",
        "holiday_name",
        "holiday_type",
        "days_to_holiday",
        "days_after_holiday",
        "is_pre_holiday_window",
        "is_post_holiday_window",
    )
