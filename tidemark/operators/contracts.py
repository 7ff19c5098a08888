"""Record contract of raw holiday items, as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import instant, iso_date
from tidemark.functions.keys import holiday_key
from tidemark.functions.text import blank, stripped

# Fixed value: the source name given to records that bring none.
DEFAULT_SOURCE = "BrasilAPI"

RECORD_COLUMNS = ["holiday_id", "date", "name", "type", "source", "ingested_at"]


def check_items(items: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """``items`` (text columns date, name, type) plus ``reject_reason``.

    The reason is NULL for a valid item, else it names the first broken field.
    A ``reject_reason`` already set by the payload scan is kept.  Columns that
    the contract does not know stay as they are.
    """
    day, name, kind = F.col("date"), F.col("name"), F.col("type")
    reason = (
        F.when(day.isNull(), "date: missing")
        .when(iso_date(day, lenient_dates).isNull(), "date: not YYYY-MM-DD")
        .when(name.isNull(), "name: missing")
        .when(blank(name), "name: blank")
        .when(kind.isNull(), "type: missing")
        .when(blank(kind), "type: blank")
    )
    if "reject_reason" in items.columns:
        reason = F.coalesce(F.col("reject_reason"), reason)
    return items.withColumn("reject_reason", reason)


def to_records(
    valid: DataFrame,
    ingested_at: dt.datetime | Column,
    source: str | Column = DEFAULT_SOURCE,
    lenient_dates: bool = False,
) -> DataFrame:
    """Canonical records with key, source and ingestion time; other columns are kept."""
    day = iso_date(F.col("date"), lenient_dates)
    name = stripped(F.col("name"))
    kind = F.lower(stripped(F.col("type")))
    extra = [c for c in valid.columns if c not in {*RECORD_COLUMNS, "reject_reason"}]
    return valid.select(
        holiday_key(day.cast("string"), name, kind).alias("holiday_id"),
        day.alias("date"),
        name.alias("name"),
        kind.alias("type"),
        (source if isinstance(source, Column) else F.lit(source)).alias("source"),
        instant(ingested_at).alias("ingested_at"),
        *extra,
    )


def split_items(
    items: DataFrame,
    ingested_at: dt.datetime | Column,
    source: str | Column = DEFAULT_SOURCE,
    lenient_dates: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Quarantine mode: (records, rejects)."""
    checked = check_items(items, lenient_dates)
    records = to_records(checked.where("reject_reason IS NULL"), ingested_at, source, lenient_dates)
    return records, checked.where("reject_reason IS NOT NULL")


def strict_records(
    items: DataFrame,
    ingested_at: dt.datetime | Column,
    source: str | Column = DEFAULT_SOURCE,
    lenient_dates: bool = False,
) -> DataFrame:
    """Strict mode: one bad item fails the whole batch, in the same pass that reads it."""
    checked = check_items(items, lenient_dates)
    complaint = F.concat(F.lit("holiday contract broken - "), F.col("reject_reason"))
    passed = checked.where(F.assert_true(F.col("reject_reason").isNull(), complaint).isNull())
    return to_records(passed, ingested_at, source, lenient_dates)
