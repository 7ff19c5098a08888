"""Catalog tables: declaration, keyed upsert, append and read-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_by
from tidemark.session import materialise, path_exists, remove_path, scratch_path, setting

RAW_HOLIDAYS = (
    "holiday_id string, date date, name string, type string, source string, ingested_at timestamp"
)
HOLIDAY_CLUSTERING = ("type", "name")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: str = RAW_HOLIDAYS,
    location: str | None = None,
    by_year_of: str | None = "date",
) -> None:
    """Create the database and the parquet table unless they exist.

    ``by_year_of`` names the date column whose year partitions the table.  A
    table declared over a ``location`` that already holds data finds its years.
    """
    known = spark.catalog.tableExists(table)
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    columns = f"{schema}, year int" if by_year_of else schema
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
    if by_year_of:
        statement += " PARTITIONED BY (year)"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)
    if by_year_of and location and not known and path_exists(spark, location):
        spark.catalog.recoverPartitions(table)


def source(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """A declared source by name, with an explicit column list."""
    df = spark.table(table)
    return df.select(*columns) if columns else df


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A staging result under a name that SQL can use; evaluated on each use."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` whose job fails on a NULL in one of ``columns``."""

    def guarded(name: str) -> Column:
        message = F.lit(f"required column {name} is NULL")
        return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name)).alias(name)

    return df.select(*(guarded(c) if c in columns else F.col(c) for c in df.columns))


def upsert(
    batch: DataFrame,
    table: str,
    key: str = "holiday_id",
    arrival: list[str] | None = None,
    by_year_of: str = "date",
    clustering: tuple[str, ...] = HOLIDAY_CLUSTERING,
) -> int:
    """Overlay ``batch`` on a year-partitioned table by key; returns the table's row count.

    A key must keep its year (the holiday key contains the date), so only the
    years that occur in the batch are read and rewritten.  Existing rows are not
    shuffled: a written batch is compared with them, and each task sorts its rows
    by year and clustering.  The merged rows are written to a scratch table
    first, which goes when the overwrite is done: the overwrite never reads what
    it replaces, and a copy outlasts a driver that dies while files are
    exchanged.  An empty batch changes nothing and returns 0.
    """
    spark = batch.sparkSession
    arrival = arrival or ["ingested_at"]
    stored = [c for c in spark.table(table).columns if c != "year"]
    # Arrival columns that the table stores as well keep their stored copy.
    order = [f"_arrival_{i}" for i in range(len(arrival))]
    given = required(batch.select(*stored, *(F.col(a).alias(o) for a, o in zip(arrival, order))), stored)
    newest = latest_by(given, [key], [F.desc(name) for name in order])
    batch_path, merged_path = scratch_path(spark, "batch"), scratch_path(spark, "merged")
    new = materialise(newest.withColumn("year", F.year(by_year_of)).drop(*order), "batch", batch_path)
    # At most one row per calendar year reaches the driver.
    years = [row["year"] for row in new.select("year").distinct().collect()]
    if not years:
        remove_path(spark, batch_path)
        return 0
    existing = spark.table(table).where(F.col("year").isin(years)).select(*stored, "year")
    merged = materialise(
        existing.join(new.select(key), key, "left_anti").select(*stored, "year").unionByName(new),
        "merged",
        merged_path,
    )
    clustered = merged.sortWithinPartitions("year", *clustering, key)
    # A catalog table takes the overwrite mode from the session, not from writer options.
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        clustered.write.insertInto(table, overwrite=True)
    remove_path(spark, batch_path)
    remove_path(spark, merged_path)
    return spark.table(table).count()


def append(df: DataFrame, table: str) -> None:
    """Add a batch to a table; required columns are those the table declares."""
    columns = df.sparkSession.table(table).columns
    required(df.select(*columns), columns).write.insertInto(table, overwrite=False)


def read_by_key(spark: SparkSession, table: str, key: str, value, columns: list[str]) -> DataFrame:
    """Rows of one key; the equality reaches the parquet scan."""
    return spark.table(table).where(F.col(key) == F.lit(value)).select(*columns)


