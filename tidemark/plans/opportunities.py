"""How sales move in the days before a holiday, by product category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import growth_pct, mean_count, mean_money
from tidemark.operators.distinct import counted
from tidemark.operators.lookup import lookup_join
from tidemark.plans.calendar import NO_HOLIDAY_NAME
from tidemark.plans.sales import BEFORE_HOLIDAY, ORDINARY_DAY, sales_context

# Score thresholds in percent, labels, and recommendation texts
# (before and after the category).
HIGH_PCT = 30.0
MEDIUM_PCT = 15.0
SCORES = ["ALTA", "MEDIA", "BAIXA"]
HIGH_TEXT = ("Oportunidade ALTA para ", ": Antecipar campanhas promocionais em D-7 e reforçar estoque.")
MEDIUM_TEXT = (
    "Oportunidade MÉDIA para ",
    ": Disparar comunicações e ofertas em D-5 com foco em conversão.",
)
LOW_TEXT = ("Demanda regular para ", ": Manter estratégia padrão sem custo extraordinário de mídia.")


def baseline_sales(facts: DataFrame) -> DataFrame:
    """Mean revenue and quantity per sale on ordinary days, by category."""
    return (
        facts.where(F.col("sales_period_context") == ORDINARY_DAY)
        .groupBy("product_category")
        .agg(
            mean_money(F.col("revenue")).alias("avg_revenue_normal"),
            mean_count(F.col("quantity")).alias("avg_quantity_normal"),
        )
    )


def next_holiday_names(holidays: DataFrame) -> DataFrame:
    """One name per holiday date (the smallest): ``next_holiday_date, next_holiday_name``."""
    return holidays.groupBy(F.col("holiday_date").alias("next_holiday_date")).agg(
        F.min("holiday_name").alias("next_holiday_name")
    )


def with_next_holiday(facts: DataFrame, holidays: DataFrame) -> DataFrame:
    """Facts of the pre-holiday window with the name of the holiday they precede."""
    before = facts.where(F.col("sales_period_context") == BEFORE_HOLIDAY).withColumn(
        "next_holiday_date", F.expr("date_add(sale_date, days_to_holiday)")
    )
    return lookup_join(before, next_holiday_names(holidays), ["next_holiday_date"])


def pre_holiday_sales(facts: DataFrame, name: str = "next_holiday_name") -> DataFrame:
    """Window figures per holiday ``name`` column and category."""
    return facts.groupBy(F.col(name).alias("holiday_name"), "product_category").agg(
        F.min("sale_date").alias("first_sale_window"),
        F.max("sale_date").alias("last_sale_window"),
        mean_money(F.col("revenue")).alias("avg_revenue_before_holiday"),
        mean_count(F.col("quantity")).alias("avg_quantity_before_holiday"),
        F.sum("revenue").alias("total_revenue_pre_holiday"),
        F.count_distinct("sale_id").alias("total_transactions_pre_holiday"),
    )


def days_before_holidays(dim: DataFrame, holidays: DataFrame) -> DataFrame:
    """Days of the pre-holiday windows and the holiday they precede: ``sale_date, holiday_name``."""
    days = dim.where(sales_context() == BEFORE_HOLIDAY).select(
        F.col("date").alias("sale_date"), F.expr("date_add(date, days_to_holiday)").alias("next_holiday_date")
    )
    named = lookup_join(days, next_holiday_names(holidays), ["next_holiday_date"])
    return named.select("sale_date", F.col("next_holiday_name").alias("holiday_name")).distinct()


def transactions_before_holidays(day_states: DataFrame, days: DataFrame) -> DataFrame:
    """Different sales per holiday and category, from states per ``sale_date`` and category.

    The states (``operators.distinct``) are kept from day to day: another calendar or
    window needs no look at the sales.
    """
    of_holidays = lookup_join(day_states, days, ["sale_date"])
    return counted(of_holidays, ["holiday_name", "product_category"], "total_transactions_pre_holiday")


def mart_opportunities(facts: DataFrame, holidays: DataFrame) -> DataFrame:
    """Growth, score and advice per upcoming holiday and category.

    A sale in the pre-holiday window counts for the holiday that it precedes
    (its next one; several holidays on that date go by the smallest name).
    """
    names = next_holiday_names(holidays).withColumnRenamed("next_holiday_date", "_next")
    dated = facts.select(
        "sale_id",
        "product_category",
        "revenue",
        "sales_period_context",
        F.when(
            F.col("sales_period_context") == BEFORE_HOLIDAY,
            F.expr("date_add(sale_date, days_to_holiday)"),
        ).alias("_next"),
    ).where(F.col("sales_period_context").isin(BEFORE_HOLIDAY, ORDINARY_DAY))
    named = lookup_join(dated, names, ["_next"], "left")
    return _scored(named.withColumn("holiday_name", F.col("next_holiday_name")))


def mart_opportunities_as_written(facts: DataFrame) -> DataFrame:
    """The mart by the sale date's own holiday name.

    Days before a holiday carry no holiday name, so the two conditions exclude
    each other and the result is always empty.
    """
    before = F.col("sales_period_context") == BEFORE_HOLIDAY
    kept = (before & (F.col("holiday_name") != NO_HOLIDAY_NAME)) | (
        F.col("sales_period_context") == ORDINARY_DAY
    )
    return _scored(facts.where(kept))


def _scored(facts: DataFrame) -> DataFrame:
    """Score facts that are either in a named window or on an ordinary day.

    One pass over the facts gives both sides: groups of the window, and one
    baseline group per category that a window function over the few groups
    hands to its neighbours.  The distinct count spreads by sale, so a popular
    holiday is not gathered in one task.
    """
    before = F.col("sales_period_context") == BEFORE_HOLIDAY
    groups = facts.groupBy(
        before.alias("_before"),
        F.when(before, F.col("holiday_name")).alias("holiday_name"),
        "product_category",
    ).agg(
        mean_money(F.col("revenue")).alias("_mean"),
        F.sum("revenue").alias("total_revenue_pre_holiday"),
        F.count_distinct(F.when(before, F.col("sale_id"))).alias("total_transactions_pre_holiday"),
    )
    category = Window.partitionBy("product_category")
    # A category that is NULL has no baseline: NULL equals nothing in a join.
    baseline = F.when(
        F.col("product_category").isNotNull(),
        F.max(F.when(~F.col("_before"), F.col("_mean"))).over(category),
    )
    grown = (
        groups.withColumn("_normal", baseline)
        .where("_before")
        .withColumn("sales_growth_pct", growth_pct(F.col("_mean"), F.col("_normal")))
    )
    return grown.select(
        "holiday_name",
        "product_category",
        F.coalesce("_normal", F.lit(0)).alias("avg_sales_normal"),
        F.col("_mean").alias("avg_sales_before_holiday"),
        "total_revenue_pre_holiday",
        "total_transactions_pre_holiday",
        "sales_growth_pct",
        _by_growth(*(F.lit(score) for score in SCORES)).alias("opportunity_score"),
        _by_growth(*(_advice(text) for text in (HIGH_TEXT, MEDIUM_TEXT, LOW_TEXT))).alias(
            "recommendation"
        ),
    )


def _by_growth(high: Column, medium: Column, low: Column) -> Column:
    growth = F.col("sales_growth_pct")
    return F.when(growth >= HIGH_PCT, high).when(growth >= MEDIUM_PCT, medium).otherwise(low)


def _advice(text: tuple[str, str]) -> Column:
    return F.concat(F.lit(text[0]), F.col("product_category"), F.lit(text[1]))
