"""The ledger of query jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import path_exists
from tidemark.sources.json_arrays import array_elements

LEDGER_SCHEMA = (
    "execution_id string, step_name string, job_id string, project_id string, "
    "start_time timestamp, end_time timestamp, bytes_processed bigint, bytes_billed bigint, "
    "estimated_cost_usd double, status string, alert_level string"
)
_FIELDS = [tuple(part.split()) for part in LEDGER_SCHEMA.split(", ")]


def _typed(name: str, kind: str) -> Column:
    """A field of the variant ``item`` in its type; NULL where it does not fit."""
    if kind == "timestamp":
        return F.try_variant_get("item", f"$.{name}", "string").try_cast("timestamp")
    if kind == "bigint":
        # Fractions round to the next whole number instead of being cut off.
        return F.round(F.try_variant_get("item", f"$.{name}", "decimal(38,9)"), 0).try_cast("bigint")
    return F.try_variant_get("item", f"$.{name}", kind)


def _items(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """What a JSON ledger holds, parsed once: ``item``, whether it ``_is_record``, and its typed fields."""
    if lines:
        text = spark.read.text(path).where(F.trim("value") != "")
        whole = F.array(F.try_parse_json("value"))
    else:
        # What cannot be read has one row, which is no record.
        text = array_elements(spark, path).select(F.concat(F.lit("["), "element", F.lit("]")).alias("value"))
        listed = F.from_json("value", "array<variant>")
        unread = F.array(F.lit(None).cast("variant"))
        whole = F.when(F.json_array_length("value").isNull(), unread).otherwise(listed)
    # Filters on items stay above a generator; below a projection each field in them would parse the text anew.
    items = text.select(F.explode(whole).alias("item"))
    is_record = F.coalesce(F.schema_of_variant("item").startswith("OBJECT"), F.lit(False))
    return items.select("item", is_record.alias("_is_record"), *(_typed(n, k).alias(n) for n, k in _FIELDS))


def ledger_items(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """All records of a JSON ledger and ``reject_reason``: one array per file, or one record per line.

    No record is left out.  A field that does not fit its type is NULL and named
    in the reason; what is no record at all has a row of NULLs and a reason.  A
    missing path is an empty ledger.  Array files are read in ranges by many tasks,
    and a broken element costs itself (see ``json_arrays``).
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{LEDGER_SCHEMA}, reject_reason string")
    reason = F.when(~F.col("_is_record"), "record: not an object")
    for name, _ in _FIELDS:
        given = F.schema_of_variant(F.try_variant_get("item", f"$.{name}", "variant"))
        reason = reason.when(F.col(name).isNull() & (given != "VOID"), f"{name}: does not fit")
    return _items(spark, path, lines).select(*(name for name, _ in _FIELDS), reason.alias("reject_reason"))


def read_json_ledger(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The records of a JSON ledger, with or without ids; see ``ledger_rejects`` for what did not fit."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return _items(spark, path, lines).where("_is_record").select(*(name for name, _ in _FIELDS))


def ledger_rejects(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """What ``read_json_ledger`` could not take as it is, with the reason."""
    return ledger_items(spark, path, lines).where("reject_reason IS NOT NULL")


def append_ledger(records: DataFrame, path: str) -> None:
    columns = [name for name, _ in _FIELDS]
    records.select(*columns).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The parquet ledger; empty while nothing has been appended."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)
