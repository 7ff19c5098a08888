"""Which content occurs in more than one place, without moving the content.

Documents live in *homes*, parts of a few MB made by a hash of the row.  Each home
sends, for every key (a 64-bit hash of some content) in it, a 32-bit tag and a
count to the *bucket* that the key's upper half names; a bucket sums the counts of
a tag over all homes and answers each home with one byte per key:

    LONE    the key occurs once in the whole table
    SHARED  it occurs more often
    HOT     it occurs more often than the limit

A home sends a key once, however many of its rows have it, so a key that a third
of all rows share costs its bucket one entry per home.  Tags of different keys may
coincide; that makes a lone key look shared and is settled by whoever compares
the content afterwards.

Homes are worked on in groups (``applyInArrow``); the same documents are dealt to
homes once, by one shuffle that every later step reads again.  Rows that are equal in id,
text and kept columns are one row with a count there, however many they are:
``repeated`` gives them back at the end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOME_BYTES = 4 << 20
#: A bucket holds about this many tags; there are as many buckets as homes up to ``FEW_BUCKETS``.
BUCKET_TAGS = 5_000_000
FEW_BUCKETS = 64
#: Copies of a row that are given back from one array.
COPIES = 10_000
_CODEC = "zstd"
LONE, SHARED, HOT = 0, 1, 2
MESSAGE = "_home int, kind string, part int, a binary, b binary, c binary, d binary"
_NAMES = ["_home", "kind", "part", "a", "b", "c", "d"]


def parts_for(docs: DataFrame, text_col: str, size: int = HOME_BYTES) -> int:
    """How many homes the texts fill."""
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    return max(1, math.ceil(total / size))


def buckets_for(homes: int, home_bytes: int, bytes_per_tag: int) -> int:
    """How many buckets the tags of all homes fill.

    A home sends a message to each bucket, so their number follows the tags and not the square of the homes.
    """
    return max(min(homes, FEW_BUCKETS), math.ceil(homes * home_bytes / bytes_per_tag / BUCKET_TAGS))


def at_home(docs: DataFrame, id_col: str, text_col: str, keep_cols: tuple[str, ...], homes: int) -> DataFrame:
    """Columns ``_home``, ``_id``, ``_text``, ``_bytes``, ``_copies`` and the kept ones, a row for all equal ones.

    Texts are packed before they are dealt out, which halves what the shuffle writes;
    ``in_order`` unpacks them.  Equal rows are counted in each batch before the shuffle and
    added up, row by row, after it.  Kept columns must be of types that can be grouped.
    """
    home = F.pmod(F.xxhash64(id_col, text_col, *keep_cols), F.lit(homes)).cast("int")
    given = docs.select(
        home.alias("_home"),
        F.col(id_col).cast("long").alias("_id"),
        F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("_text"),
        F.lit(0).alias("_bytes"),
        F.lit(1).cast("long").alias("_copies"),
        *keep_cols,
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(_CODEC, compression_level=1)
        for batch in batches:
            batch, copies = _counted(batch)
            texts = batch.column(2)
            packed = pa.array([codec.compress(text.as_buffer(), asbytes=True) for text in texts], pa.binary())
            sizes = pc.binary_length(texts).cast(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], packed, sizes, copies, *batch.columns[5:]], batch.schema.names
            )

    # One shuffle: the aggregation and all later steps find the rows dealt out by home.
    dealt = given.mapInArrow(pack, given.schema).repartition("_home")
    same = [name for name in given.columns if name != "_copies"]
    return dealt.groupBy(*same).agg(F.sum("_copies").alias("_copies")).select(*given.columns)


def _counted(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.Array]:
    """The different rows of a batch, and how many each stands for."""
    rows = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
    if len(set(rows)) == len(rows):
        return batch, batch.column(4)
    kept = zip(*(column.to_pylist() for column in batch.columns[5:])) if batch.num_columns > 5 else [()] * len(rows)
    first: dict[tuple, int] = {}
    copies: Counter = Counter()
    for i, (row, others) in enumerate(zip(rows, kept)):
        key = (*row, repr(others))
        first.setdefault(key, i)
        copies[key] += 1
    places = pa.array(first.values(), pa.int64())
    return batch.take(places), pa.array([copies[key] for key in first], pa.int64())


def repeated(rows: DataFrame) -> DataFrame:
    """Rows as often as their ``_copies`` say, without it; no array holds more than ``COPIES`` of them at once."""
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES))).alias("_block")
    left = F.least(F.lit(COPIES), F.col("_copies") - F.col("_block") * COPIES).cast("int")
    names = [name for name in rows.columns if name != "_copies"]
    one = F.explode(F.array_repeat(F.lit(0), left)).alias("_one")
    return rows.select("*", block).select(*names, one).select(*names)


def in_order(table: pa.Table) -> pa.Table:
    """Rows of a home, unpacked, in an order that does not depend on how they came."""
    order = pc.sort_indices(table, sort_keys=[("_id", "ascending"), ("_text", "ascending")], null_placement="at_end")
    table = table.take(order)
    codec = pa.Codec(_CODEC)
    sizes = table.column("_bytes").to_pylist()
    texts = [codec.decompress(x.as_buffer(), n, asbytes=True) for x, n in zip(table.column("_text"), sizes)]
    return table.set_column(table.schema.get_field_index("_text"), "_text", pa.array(texts, pa.binary()))


def ids_of(table: pa.Table) -> np.ndarray:
    """Ids as numbers, null after all others."""
    return pc.fill_null(table.column("_id"), np.iinfo(np.int64).max).to_numpy().astype(np.int64)


def message(rows: list[tuple]) -> pa.Table:
    """Rows of home, kind, part and up to four arrays."""
    columns = list(zip(*((*row, *([None] * (7 - len(row)))) for row in rows))) or [()] * 7
    kinds = [pa.int32(), pa.string(), pa.int32()] + [pa.binary()] * 4
    packed = [
        pa.array([x if x is None or isinstance(x, (str, int, bytes)) else np.ascontiguousarray(x).tobytes() for x in c], k)
        for c, k in zip(columns, kinds)
    ]
    return pa.Table.from_arrays(packed, _NAMES)


def empty_message() -> pa.Table:
    return message([])


def by_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key."""
    return ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _tags_order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct keys in messages, and their buckets in that order."""
    bucket = by_bucket(keys, buckets)
    order = np.lexsort((keys, bucket))
    return order, bucket[order]


def tags(home: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """Messages of a home about its distinct keys and how often each occurs in it."""
    order, bucket = _tags_order(keys, buckets)
    tag = (keys[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    count = np.minimum(counts[order], 0xFFFF).astype(np.uint16)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    return message(
        [(home, "tags", int(bucket[i]), tag[i:j], count[i:j]) for i, j in zip(cuts[:-1], cuts[1:])] if len(keys) else []
    )


def judge(hot: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """For a bucket: what each home is told about its keys."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        tag = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("a")]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in table.column("b")]).astype(np.int64)
        _, where = np.unique(np.concatenate(tag), return_inverse=True)
        total = np.bincount(where, counts)[where]
        verdict = np.where(total > hot, HOT, np.where(total > 1, SHARED, LONE)).astype(np.uint8)
        ends = np.cumsum([len(x) for x in tag])
        homes = table.column("_home").to_pylist()
        return message(
            [(home, "verdict", bucket, verdict[end - len(x) : end]) for home, end, x in zip(homes, ends, tag)]
        )

    return run


def verdicts(keys: np.ndarray, buckets: int, answers: pa.Table) -> np.ndarray:
    """The verdict on each distinct key of a home, from the answers of the buckets."""
    found = np.zeros(len(keys), np.uint8)
    if not len(keys):
        return found
    order, _ = _tags_order(keys, buckets)
    by_part = sorted(zip(answers.column("part").to_pylist(), answers.column("a").to_pylist()))
    found[order] = np.frombuffer(b"".join(x for _, x in by_part), np.uint8)
    return found


def of_kind(answers: pa.Table, kind: str) -> pa.Table:
    return answers.filter(pc.equal(answers.column("kind"), kind))


def take_census(homes: DataFrame, count: Callable[[int, pa.Table], pa.Table], hot: int) -> DataFrame:
    """The answers to all homes; ``count`` makes the tag messages of a home from its rows in order."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return count(key[0].as_py(), in_order(table))

    sent = homes.groupBy("_home").applyInArrow(run, MESSAGE)
    return sent.groupBy("part").applyInArrow(judge(hot), MESSAGE)


def with_answers(
    homes: DataFrame, answers: DataFrame, work: Callable[[int, pa.Table, pa.Table], pa.Table], schema
) -> DataFrame:
    """``work`` on every home's rows in order and the answers to it."""

    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        return work(key[0].as_py(), in_order(table), told)

    return homes.groupBy("_home").cogroup(answers.groupBy("_home")).applyInArrow(run, schema)
