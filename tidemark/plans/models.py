"""All model tables from raw holidays and raw sales."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.plans.calendar import FIRST_DAY, LAST_DAY, commercial_calendar, dim_calendar
from tidemark.plans.opportunities import mart_opportunities
from tidemark.plans.sales import fct_sales
from tidemark.plans.staging import stg_holidays, stg_sales
from tidemark.session import materialise


def build_models(
    raw_holidays: DataFrame,
    raw_sales: DataFrame,
    first: dt.date = FIRST_DAY,
    last: dt.date = LAST_DAY,
    location: str | None = None,
    on_duplicate_date: str = "all",
) -> dict[str, DataFrame]:
    """The relations by name; calendar, fact and mart are written, staging stays lazy.

    ``location`` is the folder of the written tables; without it they go to the
    scratch folder.  The staged holidays are written too, because the calendar
    and the mart read them several times.
    """
    spark = raw_sales.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        return materialise(df, name, f"{location.rstrip('/')}/{name}" if location else None)

    holidays = written(stg_holidays(raw_holidays), "stg_holidays")
    sales = stg_sales(raw_sales)
    calendar = written(
        commercial_calendar(spark, holidays, first, last, on_duplicate_date), "commercial_calendar"
    )
    dim = written(dim_calendar(calendar), "dim_calendar")
    facts = written(fct_sales(sales, dim), "fct_sales")
    mart = written(mart_opportunities(facts, holidays), "mart_opportunities")
    return {
        "stg_holidays": holidays,
        "stg_sales": sales,
        "commercial_calendar": calendar,
        "dim_calendar": dim,
        "fct_sales": facts,
        "mart_opportunities": mart,
    }
