"""Exact distinct counts that can be merged: bitmaps over numbered values.

Values are numbered once, those first seen together next to each other, so that the
values of a day fill few bitmaps.  A state is a row per key and stretch of 32,768 numbers
with a bit per value.  States of several keys, or of several batches, are merged by their
bits, and a value in many of them counts once; the rows they came from are not read again.

Null values count for nothing, but a key that has only nulls counts 0.  Null keys are keys
like others.  Values that a batch repeats, also in another batch, keep their numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

NUMBER, BUCKET, BITS = "_number", "_bucket", "_bits"


def numbered(df: DataFrame, value: str, order: list[str], known: DataFrame | None = None) -> DataFrame:
    """Numbers of all values, written: those ``known`` and, after them, the new ones of ``df``.

    New values are numbered by the least ``order`` columns they stand with.
    """
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(F.struct(*order)).alias("_first"))
    start = 0
    if known is not None:
        first = first.join(known.select(value), value, "left_anti")
        start = known.agg(F.max(NUMBER)).first()[0] or 0
    ranged = first.repartitionByRange("_first", value).sortWithinPartitions("_first", value)
    # Each task counts on from its own start; what lies between the starts has no bitmaps.
    new = ranged.select(value, (F.monotonically_increasing_id() + F.lit(start + 1)).alias(NUMBER))
    written = materialise(new, "numbers")
    return written if known is None else known.unionByName(written)


def states(df: DataFrame, value: str, keys: list[str], numbers: DataFrame) -> DataFrame:
    """The keys with ``_bucket`` and ``_bits``; a value without a number is an error."""
    pairs = df.select(*keys, value).distinct().join(numbers, value, "left")
    missing = F.col(value).isNotNull() & F.col(NUMBER).isNull()
    number = F.when(missing, F.raise_error(F.lit("value without a number"))).otherwise(F.col(NUMBER))
    placed = pairs.select(*keys, number.alias(NUMBER))
    return placed.groupBy(*keys, F.bitmap_bucket_number(NUMBER).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS)
    )


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """States per ``keys`` from states of finer keys or of several batches."""
    return parts.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(parts: DataFrame, keys: list[str], into: str) -> DataFrame:
    """Distinct values per ``keys``."""
    return merged(parts, keys).groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(into))
