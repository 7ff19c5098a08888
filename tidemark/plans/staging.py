"""Cleaned, typed and deduplicated inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.money import AMOUNT
from tidemark.functions.text import trimmed
from tidemark.operators.latest import latest_by


def stg_holidays(raw: DataFrame) -> DataFrame:
    """Holidays, the most recently ingested record per ``holiday_id``."""
    typed = raw.select(
        "holiday_id",
        F.col("date").cast("date").alias("holiday_date"),
        trimmed(F.col("name")).alias("holiday_name"),
        F.lower(trimmed(F.col("type"))).alias("holiday_type"),
        F.col("source").alias("data_source"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )
    return latest_by(typed, ["holiday_id"], [F.desc("ingested_at")])


def stg_sales(raw: DataFrame) -> DataFrame:
    """Sales with types; the columns of ``raw`` other than the eight are dropped."""
    return raw.select(
        "sale_id",
        F.col("sale_date").cast("date").alias("sale_date"),
        trimmed(F.col("product_id")).alias("product_id"),
        trimmed(F.col("product_category")).alias("product_category"),
        _whole(raw, "quantity"),
        F.col("unit_price").cast(AMOUNT).alias("unit_price"),
        F.col("revenue").cast(AMOUNT).alias("revenue"),
        trimmed(F.col("region")).alias("region"),
    )


def _whole(df: DataFrame, name: str) -> Column:
    """Whole numbers; fractions round half away from zero instead of being cut off."""
    number = F.col(name)
    if isinstance(df.schema[name].dataType, (T.FractionalType, T.DecimalType)):
        number = F.round(number, 0)
    return number.cast("bigint").alias(name)
