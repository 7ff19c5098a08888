"""The data tests of the model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.checks import Tests, report
from tidemark.plans.opportunities import SCORES
from tidemark.plans.sales import CONTEXTS

# The holiday types that staging accepts.
HOLIDAY_TYPES = ["national", "facultativo", "state", "municipal"]


def positive_revenue_violations(sales: DataFrame) -> DataFrame:
    """Sales with negative revenue or without quantity: ``sale_id, revenue, quantity``."""
    return sales.where(_not_positive()).select("sale_id", "revenue", "quantity")


def _not_positive():
    return (F.col("revenue") < 0) | (F.col("quantity") <= 0)


def suite() -> list[Tests]:
    """35 declarative tests and one business rule, by relation.  Fixed values: columns and tests."""
    return [
        Tests(
            "stg_holidays",
            unique=("holiday_id",),
            not_null=(
                "holiday_id",
                "holiday_date",
                "holiday_name",
                "holiday_type",
                "data_source",
                "ingested_at",
            ),
            accepted={"holiday_type": HOLIDAY_TYPES},
        ),
        Tests(
            "stg_sales",
            unique=("sale_id",),
            not_null=("sale_id", "sale_date", "revenue"),
            rules={"positive_revenue": ("revenue", _not_positive())},
        ),
        Tests(
            "commercial_calendar",
            unique=("calendar_date",),
            not_null=("calendar_date", "is_weekend", "is_holiday", "is_business_day"),
        ),
        Tests(
            "dim_calendar",
            unique=("date",),
            not_null=("date", "is_business_day", "is_holiday"),
        ),
        Tests(
            "fct_sales",
            unique=("sale_id",),
            not_null=("sale_id", "sale_date", "quantity", "revenue", "sales_period_context"),
            accepted={"sales_period_context": CONTEXTS},
            parents={"sale_date": ("dim_calendar", "date")},
        ),
        Tests(
            "mart_opportunities",
            not_null=(
                "holiday_name",
                "product_category",
                "sales_growth_pct",
                "opportunity_score",
                "recommendation",
            ),
            accepted={"opportunity_score": SCORES},
        ),
    ]


def data_quality_report(relations: dict[str, DataFrame]) -> DataFrame:
    """The whole suite over the tables that ``build_models`` returns."""
    return report(relations, suite())
