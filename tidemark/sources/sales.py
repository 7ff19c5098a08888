"""Raw sales from CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SALES_SCHEMA = (
    "sale_id string, sale_date date, product_id string, product_category string, "
    "quantity bigint, unit_price decimal(28,9), revenue decimal(28,9), region string"
)


def read_sales_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sales with the declared schema; a line that does not fit fails the read."""
    return spark.read.csv(path, schema=SALES_SCHEMA, header=True, mode="FAILFAST")
