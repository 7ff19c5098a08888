"""Sales in their calendar context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join

# The calendar contexts of a sale.
ON_HOLIDAY = "DURANTE_FERIADO"
BEFORE_HOLIDAY = "PRE_FERIADO"
AFTER_HOLIDAY = "POS_FERIADO"
ORDINARY_DAY = "DIA_COMUM"
CONTEXTS = [ORDINARY_DAY, BEFORE_HOLIDAY, ON_HOLIDAY, AFTER_HOLIDAY]

# The columns of a sale and of its calendar day.
SALE_COLUMNS = [
    "sale_id",
    "sale_date",
    "product_id",
    "product_category",
    "quantity",
    "unit_price",
    "revenue",
    "region",
]
CALENDAR_COLUMNS = [
    "day_name",
    "month_name",
    "year",
    "is_weekend",
    "is_business_day",
    "is_holiday",
    "holiday_name",
    "days_to_holiday",
    "days_after_holiday",
    "is_pre_holiday_window",
    "is_post_holiday_window",
]


def sales_context() -> Column:
    """A holiday outranks the days before one, which outrank the days after one."""
    return (
        F.when(F.col("is_holiday"), ON_HOLIDAY)
        .when(F.col("is_pre_holiday_window"), BEFORE_HOLIDAY)
        .when(F.col("is_post_holiday_window"), AFTER_HOLIDAY)
        .otherwise(ORDINARY_DAY)
    )


def within_calendar(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """The sales between the first and last day of the calendar.

    The two dates become literals: a date column is then filtered in the scan,
    which skips the files and partitions of other years.
    """
    low, high = dim.agg(F.min("date"), F.max("date")).first()
    if low is None:
        return sales.limit(0)
    return sales.where(F.col("sale_date").between(F.lit(low), F.lit(high)))


def fct_sales(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """Each sale once per calendar row of its date; sales outside the calendar drop out.

    ``dim`` should be a written table: its bounds are looked up first, and Spark
    broadcasts it while it is small, so the sales are not shuffled.
    """
    days = dim.select(
        F.col("date").alias("sale_date"), *CALENDAR_COLUMNS, sales_context().alias("sales_period_context")
    )
    dated = within_calendar(sales.select(*SALE_COLUMNS), dim)
    facts = lookup_join(dated, days, ["sale_date"])
    return facts.select(*SALE_COLUMNS, *CALENDAR_COLUMNS, "sales_period_context")


def sales_by_context(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """Number of fact rows per context: ``sales_period_context, n_sales``.

    Sales are counted per date before they meet the calendar: what is shuffled
    is one row per date and task, whatever the number of sales.
    """
    dated = within_calendar(sales, dim)
    per_day = dated.groupBy("sale_date").agg(F.count(F.lit(1)).alias("n"))
    days = dim.select(F.col("date").alias("sale_date"), sales_context().alias("sales_period_context"))
    return (
        per_day.join(days, "sale_date")
        .groupBy("sales_period_context")
        .agg(F.sum("n").alias("n_sales"))
    )


def sales_outside_calendar(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """The sales that the fact table drops for want of a calendar day."""
    known = dim.select(F.col("date").alias("sale_date")).distinct()
    return lookup_join(sales, known, ["sale_date"], "left_anti")
