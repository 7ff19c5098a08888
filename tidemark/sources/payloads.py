"""Holiday payloads: JSON arrays of ``{date, name, type}`` as an API returns them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("date", "name", "type")


def year_paths(folder: str, years: list[int]) -> list[str]:
    """Where the landed response of each year lies: ``<folder>/<year>.json``."""
    return [f"{folder.rstrip('/')}/{year}.json" for year in years]


def read_bodies(spark: SparkSession, paths: list[str], whole_files: bool = True) -> DataFrame:
    """Response bodies with their place: ``body, path_no, file, block, line_no``.

    In this order the place is the order of arrival: the position in ``paths``,
    then file name, block of the file and line.

    ``whole_files`` reads one body per file (one landed response each);
    otherwise every line holds a body, which lets Spark split large files.
    Paths may be folders or globs; what they hold twice is kept twice.
    """

    def one(path_no: int, path: str) -> DataFrame:
        text = spark.read.text(path, wholetext=whole_files)
        return text.select(
            F.col("value").alias("body"),
            F.lit(path_no).alias("path_no"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            (F.lit(0).cast("bigint") if whole_files else F.monotonically_increasing_id()).alias("line_no"),
        )

    return reduce(DataFrame.unionByName, [one(i, path) for i, path in enumerate(paths)])


def rejected_bodies(bodies: DataFrame) -> DataFrame:
    """Bodies that are no JSON array."""
    return bodies.where(_length().isNull()).withColumn("reject_reason", F.lit("payload: not a list"))


def payload_items(bodies: DataFrame, strict: bool = False) -> DataFrame:
    """The items of all bodies: ``date, name, type, reject_reason`` and their place.

    Unknown fields are dropped.  A field that is not text counts as broken: the
    contract wants strings, and a parser with a text schema would turn the
    number 20260101 into one.  Bodies that are no array are left to
    ``rejected_bodies``, or fail the job if ``strict``.
    """
    is_list = _length().isNotNull()
    if strict:
        lists = bodies.where(F.assert_true(is_list, F.lit("payload: not a list")).isNull())
    else:
        lists = bodies.where(is_list)
    place = [c for c in bodies.columns if c != "body"]
    items = lists.select(
        *place, F.posexplode(F.from_json("body", "array<variant>")).alias("item_no", "item")
    )
    kinds = {name: F.col(f"_{name}") for name in FIELDS}
    typed = items.select("*", *(_kind(_field(name, "variant")).alias(f"_{name}") for name in FIELDS))
    # Only an item without any of the fields needs a look at its own kind.
    fieldless = F.coalesce(*kinds.values()).isNull()
    is_object = F.coalesce(_kind(F.col("item")).startswith("OBJECT"), F.lit(False))
    wrong = F.when(fieldless & ~is_object, "item: not an object")
    for name, kind in kinds.items():
        # VOID is an explicit null: the contract reports it as missing.
        wrong = wrong.when(~kind.isin("STRING", "VOID"), f"{name}: not text")
    return typed.select(
        *(_field(name, "string").alias(name) for name in FIELDS),
        wrong.alias("reject_reason"),
        *place,
        "item_no",
    )


def _length() -> Column:
    return F.json_array_length(F.col("body"))


def _field(name: str, kind: str) -> Column:
    return F.try_variant_get(F.col("item"), f"$.{name}", kind)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)
