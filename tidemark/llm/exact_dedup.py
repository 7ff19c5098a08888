"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after lower-casing A-Z only; null counts as empty.  Of
equal texts the row with the largest id stays (null ids come before all others).

1. Every text becomes the SHA-256 of its normalised bytes; digests, ids and a row number
   are written once, and all later steps read these few bytes a row.
2. Each task sums up its digests in a Misra-Gries summary of ``counters`` counters.  A
   summary of ``n`` rows counts a digest short by at most ``n / (counters + 1)``, and the
   sum of all summaries by at most ``N / (counters + 1)`` of ``N`` rows.  So digests
   whose summed counter exceeds that are at most ``counters + 1``, and all with twice as
   many rows are among them.
3. The candidates are verified: their rows are counted exactly and their winners found
   with partial aggregates, one row per candidate and task.
4. The verified winners, at most ``counters + 1`` rows, are broadcast and settle their
   rows where they lie.  The rows of the other digests are shuffled by digest; each has
   fewer than ``2 N / (counters + 1)`` rows.

Nulls: a null text is an empty one; a null id loses against any other, and a group of
null ids has a null ``keep_id``.  Repeated rows: exactly one row of a group is kept, even
if others repeat its id.  Empty tables give empty results.  Other columns of the input are
not looked at but for ``keep_cols``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialise

#: Counters of a summary; also bounds the broadcast: one row of some 60 bytes each.
COUNTERS = 4096


class Summary:
    """Misra-Gries counters of binary values, fed with whole batches."""

    def __init__(self, counters: int):
        self.counters = counters
        self.counts: dict[bytes, int] = {}

    def add(self, values: pa.Array) -> None:
        """Add the batch's exact counts, then take what the next largest counter has from all."""
        counts = self.counts
        for found in pc.value_counts(values).to_pylist():
            counts[found["values"]] = counts.get(found["values"], 0) + found["counts"]
        if len(counts) > self.counters:
            least = sorted(counts.values(), reverse=True)[self.counters]
            self.counts = {value: n - least for value, n in counts.items() if n > least}


def digests(docs: DataFrame, id_col: str, text_col: str, keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``_id``, ``_digest`` and the kept ones."""
    given = docs.select(F.col(id_col).alias("_id"), F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("_digest"), *keep_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.lower() changes A-Z and nothing else.
            found = [hashlib.sha256(text.as_py().lower()).digest() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), *batch.columns[2:]], batch.schema.names
            )

    return given.mapInArrow(run, given.schema)


def frequent(values: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """Values of a binary column that may hold a large part of the rows.

    At most ``counters + 1`` rows; every value with ``2 N / (counters + 1)`` of the ``N`` rows is among them.
    """
    schema = T.StructType([T.StructField(column, T.BinaryType()), T.StructField("_count", T.LongType()), T.StructField("_rows", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, rows = Summary(counters), 0
        for batch in batches:
            rows += batch.num_rows
            summary.add(batch.column(0))
        # The rows of the task go along with a null value.
        found = [*summary.counts, None]
        counts = [*summary.counts.values(), 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), pa.array(counts, pa.int64()), pa.array([0] * len(summary.counts) + [rows], pa.int64())],
            [column, "_count", "_rows"],
        )

    summed = values.select(column).mapInArrow(run, schema).groupBy(column).agg(F.sum("_count").alias("_count"), F.sum("_rows").alias("_rows"))
    summed = materialise(summed, "summaries")
    total = summed.agg(F.sum("_rows").alias("n")).first()["n"] or 0
    return summed.where(F.col(column).isNotNull() & (F.col("_count") * (counters + 1) >= F.lit(total))).select(column)


def mark_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    counters: int = COUNTERS,
    keep_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and the kept columns."""
    read = digests(docs, id_col, text_col, keep_cols).withColumn("_row", F.monotonically_increasing_id())
    rows = materialise(read, "digests")
    # The row number tells repeated rows apart; nulls are the least.
    winner = F.max(F.struct("_id", "_row")).alias("_winner")
    size = F.count(F.lit(1)).alias("_size")
    candidates = F.broadcast(frequent(rows, "_digest", counters))
    verified = rows.join(candidates, "_digest", "left_semi").groupBy("_digest").agg(winner, size)
    verified = F.broadcast(materialise(verified, "winners"))
    settled = rows.join(verified, "_digest")
    group = Window.partitionBy("_digest")
    others = rows.join(verified, "_digest", "left_anti").select(
        "*", F.max(F.struct("_id", "_row")).over(group).alias("_winner"), F.count(F.lit(1)).over(group).alias("_size")
    )
    return settled.unionByName(others).select(
        F.col("_id").alias(id_col),
        F.col("_winner._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_winner._row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
        *keep_cols,
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    # Only numbered rows and digests are shuffled; the rows themselves are struck out where they lie.
    place = "_place" + "_" * max(map(len, docs.columns), default=0)
    numbered = materialise(docs.withColumn(place, F.monotonically_increasing_id()), "numbered")
    marked = mark_duplicates(numbered, id_col, text_col, counters, keep_cols=(place,))
    return numbered.join(marked.where("kept").select(place), place, "left_semi").drop(place)
