"""Ranked lexical search, pipelined over term owners.

Every item of a query table gets its best documents by a sum of integer contributions of
the item's terms.  Terms are maximal runs of ASCII digits and letters (lower-cased) and of
non-ASCII code points.

1. *Index.*  One pass over the documents counts terms and cuts the rows into *blocks* of
   at most ``BLOCK_DOCS`` documents or ``BLOCK_POSTINGS`` postings.  A block writes one row
   per term: places in the block, occurrences, document lengths, packed.  Terms that no
   item has are left out by a bitmap of ``BITMAP_BYTES`` bytes, whatever the items' number;
   what slips through falls out of the join with the items' terms.
2. *Owners.*  Weights follow from the number of documents per term.  A term belongs to the
   owner of its weight's range (``CUTS``), the rarest terms to the first; the postings are
   written once more, by owner, with their contributions worked out.
3. *Pipeline.*  Items are dealt to *bundles* of about ``BUNDLE_ITEMS``.  A bundle carries
   the sparse accumulators (item, place, score) of a block through the owners one after
   the other: each stage cogroups the bundles with the postings that the owner has for
   them, by bundle and block, and adds.  After a stage an item's tenth best score so far
   is known; what a document could still get from later owners is bounded by their
   weights.  Accumulators that cannot reach the tenth best are dropped, and none are begun
   once a document without terms of earlier owners cannot reach it.  Both are exact.
4. *Selection.*  The last stage keeps the best of each block, then of all blocks.

Rows are documents of their own, also with equal ids; so are items: a repeated item row
has result rows of its own.  Equal scores go by ascending id, null ids last, then by the
order of rows.  Null and empty texts have no term, are in no result and count neither in
``N`` nor in ``L``.  Very long texts end a block early.  Empty tables give empty results.
Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialise, scratch_path

TOP = 10
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 2_000_000
BITMAP_BYTES = 1 << 20
BUNDLE_ITEMS = 128
#: Least weights of the owners but the last.  An owner's terms are about e times as frequent as those before at 1000.
CUTS = (5000, 3500, 2000)
#: Of every fraction that a weight is multiplied by.
LARGEST_SHARE = 1_000_000
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def term_counts(text: bytes) -> Counter:
    """Terms of a text in UTF-8 and how often each occurs."""
    return Counter(_TERM.findall(text.lower()))


def _texts(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return table.select(F.col(id_col).alias("_id"), F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("_text"))


# ---------------------------------------------------------------- items


def item_terms(items: DataFrame, id_col: str, text_col: str, bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
    """Columns ``_item`` (row), ``_id``, ``bundle``, ``slot``, ``term`` and ``times``, written.

    Bundles are made by hash and numbered inside, so that no task sees all items.
    """
    given = materialise(_texts(items, id_col, text_col).withColumn("_item", F.monotonically_increasing_id()), "items")
    bundles = max(1, math.ceil(given.count() / bundle_items))
    placed = given.withColumn("bundle", F.pmod(F.xxhash64("_item"), F.lit(bundles)).cast("int")).withColumn(
        "slot", F.row_number().over(Window.partitionBy("bundle").orderBy("_item")) - 1
    )
    schema = T.StructType([*placed.select("_item", "_id", "bundle", "slot").schema.fields, T.StructField("term", T.BinaryType()), T.StructField("times", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms, times = [], [], []
            for i, text in enumerate(batch.column(4)):
                for term, n in term_counts(text.as_py()).items():
                    rows.append(i)
                    terms.append(term)
                    times.append(n)
            head = batch.select(["_item", "_id", "bundle", "slot"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*head.columns, pa.array(terms, pa.binary()), pa.array(times, pa.int64())], schema.names)

    return materialise(placed.select("_item", "_id", "bundle", "slot", "_text").mapInArrow(run, schema), "item-terms")


def _places(terms: list[bytes], bits: int) -> np.ndarray:
    return np.array([zlib.crc32(term) for term in terms], np.int64) % bits


def bitmap_of(terms: DataFrame, size: int = BITMAP_BYTES) -> bytes:
    """A bitmap of ``size`` bytes with a bit for the hash of every term; made in tasks, united two by two."""
    bits = 8 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits, bool)
        for batch in batches:
            own[_places(batch.column(0).to_pylist(), bits)] = True
        packed = np.packbits(own, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["bits"])

    # As few tasks as there are terms to fill them; each sends one bitmap.
    parts = terms.select("term").distinct().coalesce(8).mapInArrow(run, "bits binary")
    found = np.zeros(size, np.uint8)
    for row in parts.toLocalIterator():
        found |= np.frombuffer(row["bits"], np.uint8)
    return found.tobytes()


# ---------------------------------------------------------------- index


_INDEX = "block long, term binary, n_docs long, n_terms long, places binary, times binary, lengths binary"


class _Block:
    """Postings of some documents, as they are read."""

    def __init__(self):
        self.ids: list = []
        self.lengths = array("q")
        self.numbers: dict[bytes, int] = {}
        self.term, self.doc, self.times = array("I"), array("I"), array("I")

    def add(self, doc_id, counts: Counter, known: bytes, bits: int) -> None:
        place = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        numbers = self.numbers
        for term, n in counts.items():
            number = numbers.get(term)
            if number is None:
                h = zlib.crc32(term) % bits
                if not known[h >> 3] >> (h & 7) & 1:
                    continue
                number = numbers[term] = len(numbers)
            self.term.append(number)
            self.doc.append(place)
            self.times.append(n)

    def rows(self, block: int, id_type: pa.DataType) -> pa.RecordBatch:
        """A row per term, and one without a term that has the ids and the totals."""
        lengths = np.array(self.lengths, np.int64)
        ids = pa.array(self.ids, id_type)
        # Places go by id, so that the first of equal scores is the one to be returned; nulls come last.
        order = np.array(pa.compute.array_sort_indices(ids, null_placement="at_end"), np.int64)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        term, doc = np.array(self.term, np.int64), place[np.array(self.doc, np.int64)]
        by_term = np.lexsort((doc, term))
        term, doc, times = term[by_term], doc[by_term], np.array(self.times, np.uint32)[by_term]
        length = lengths[order][doc].astype(np.uint32)
        cuts = np.searchsorted(term, np.arange(len(self.numbers) + 1))
        parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        pack = lambda values: pa.array([values[i:j].tobytes() for i, j in parts] + [None], pa.binary())
        columns = [
            pa.array([block] * (len(parts) + 1), pa.int64()),
            pa.array([*self.numbers, None], pa.binary()),
            pa.array([j - i for i, j in parts] + [int((lengths > 0).sum())], pa.int64()),
            pa.array([0] * len(parts) + [int(lengths.sum())], pa.int64()),
            pack(doc),
            pack(times),
            pack(length),
            pa.array([None] * len(parts) + [ids.take(pa.array(order))], pa.list_(id_type)),
        ]
        return pa.RecordBatch.from_arrays(columns, [part.split(" ")[0] for part in _INDEX.split(", ")] + ["ids"])


def build_index(docs: DataFrame, id_col: str, text_col: str, known: bytes, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Postings by block and term, written; the rows without a term have ids, documents and terms of a block."""
    given = _texts(docs, id_col, text_col)
    schema = T.StructType([*T.StructType.fromDDL(_INDEX).fields, T.StructField("ids", T.ArrayType(given.schema["_id"].dataType))])
    bits = 8 * len(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, number, id_type = _Block(), 0, None
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(text.as_py())
                if counts:
                    block.add(doc_id, counts, known, bits)
                if len(block.ids) >= block_docs or len(block.term) >= block_postings:
                    yield block.rows(part << 32 | number, id_type)
                    block, number = _Block(), number + 1
        if block.ids:
            yield block.rows(part << 32 | number, id_type)

    return materialise(given.mapInArrow(run, schema), "postings")


# ---------------------------------------------------------------- owners


def weighed_terms(index: DataFrame, terms: DataFrame, n_docs: int, cuts: tuple[int, ...] = CUTS) -> DataFrame:
    """The items' terms that weigh anything, with ``weight`` and ``owner``, written."""
    of_term = index.where("term IS NOT NULL").groupBy("term").agg(F.sum("n_docs").alias("df"))
    ratio = F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)
    weight = F.floor(1000.0 * F.log(ratio)).cast("long")
    owner = sum((F.when(F.col("weight") < cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    wanted = terms.select("term").distinct().join(of_term, "term")
    return materialise(wanted.withColumn("weight", weight).where("weight > 0").withColumn("owner", owner), "weights")


def _with_shares(rows: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Postings with ``shares``, what a weight is multiplied by in each document, for the occurrences and lengths."""
    schema = T.StructType([*rows.drop("times", "lengths").schema.fields, T.StructField("shares", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = []
            for times, lengths in zip(batch.column("times"), batch.column("lengths")):
                tf = np.frombuffer(times.as_buffer(), np.uint32).astype(np.int64)
                n = np.frombuffer(lengths.as_buffer(), np.uint32).astype(np.int64)
                m = 100 - 75 + (75 * n * n_docs) // n_terms
                shares.append(((1_000_000_000 * tf) // (1000 * tf + 8 * m)).astype(np.uint32).tobytes())
            rest = batch.select([name for name in batch.schema.names if name not in ("times", "lengths")])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(shares, pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


# ---------------------------------------------------------------- pipeline


#: What a bundle carries of a block; ``best`` are the first scores of each slot so far.
_CARRIED = (
    "bundle int, block long, slots binary, places binary, scores binary, "
    "best array<struct<slot: int, place: int, score: bigint>>"
)
_NAMES = ["bundle", "block", "slots", "places", "scores", "best"]
_KINDS = (np.uint16, np.uint32, np.int64)
_BEST = pa.struct([("slot", pa.int32()), ("place", pa.int32()), ("score", pa.int64())])


def _packed(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind).astype(np.int64) for x in column]


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    lists = column.combine_chunks()
    values = lists.values.to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy()
    return [values[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _first_of_each(slots: np.ndarray, places: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` best of each slot, equal scores by place."""
    order = np.lexsort((places, -scores, slots))
    begin = np.searchsorted(slots[order], slots[order], side="left")
    return order[np.arange(len(order)) - begin < top]


def _add(top: int, last: bool):
    """A stage for one bundle and block: the accumulators with what the owner's postings add to them."""

    def run(key: tuple, carried: pa.Table, postings: pa.Table) -> pa.Table:
        slots, places, scores = (
            np.concatenate([np.zeros(0, np.int64), *_packed(carried.column(name), kind)])
            for name, kind in zip(_NAMES[2:5], _KINDS)
        )
        at, shares = _packed(postings.column("places"), np.uint32), _packed(postings.column("shares"), np.uint32)
        told = [_lists(postings.column(name)) for name in ("of_slots", "of_weights", "of_begins", "of_needs")]
        n_slots = 1 + max([-1, *(int(x.max()) for x in (slots, *told[0]) if len(x))])
        width = 1 + max([-1, *(int(x.max()) for x in (places, *at) if len(x))])
        total = np.zeros((n_slots, width), np.int64)
        total[slots, places] = scores
        begun, needs = total > 0, np.zeros(n_slots, np.int64)
        for docs, share, of_slots, weights, begins, need in zip(at, shares, *told):
            needs[of_slots] = need
            for slot, weight, begin in zip(of_slots.tolist(), weights.tolist(), begins.tolist()):
                if begin:
                    total[slot, docs] += weight * share
                else:
                    known = begun[slot, docs]
                    total[slot, docs[known]] += weight * share[known]
        slots, places = np.nonzero(total)
        scores = total[slots, places]
        # Of items without postings here nothing is known; they keep what they have.
        possible = scores >= needs[slots]
        slots, places, scores = slots[possible], places[possible], scores[possible]
        best = _first_of_each(slots, places, scores, top)
        firsts = pa.StructArray.from_arrays(
            [pa.array(x[best], kind.type) for x, kind in zip((slots, places, scores), _BEST)], fields=list(_BEST)
        )
        left = [np.zeros(0)] * 3 if last else [slots, places, scores]
        row = [
            pa.array([key[0].as_py()], pa.int32()),
            pa.array([key[1].as_py()], pa.int64()),
            *(pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in zip(left, _KINDS)),
            pa.ListArray.from_arrays(pa.array([0, len(best)], pa.int32()), firsts),
        ]
        return pa.Table.from_arrays(row, _NAMES).slice(0, int(len(best) > 0))

    return run


def _told(weights: DataFrame, least: DataFrame, owner: int) -> DataFrame:
    """What an owner is told of a bundle, per term and bundle: slots, weights, whether documents
    without a score may begin, and the score that a document needs after this owner.

    ``weights`` has a row per item and term; ``least`` the tenth best score of an item so far.
    """
    bound = F.col("times") * F.col("weight") * LARGEST_SHARE
    open_ = weights.where(F.col("owner") >= owner).groupBy("bundle", "slot").agg(
        F.sum(bound).alias("more"), F.sum(F.when(F.col("owner") > owner, bound).otherwise(0)).alias("later")
    )
    own = weights.where(F.col("owner") == owner).select("term", "bundle", "slot", (F.col("times") * F.col("weight")).alias("weight"))
    told = own.join(open_, ["bundle", "slot"]).join(least, ["bundle", "slot"], "left")
    at_least = F.coalesce("least", F.lit(0))
    of = F.struct(F.col("slot").alias("slots"), F.col("weight").alias("weights"), (F.col("more") >= at_least).alias("begins"), (at_least - F.col("later")).alias("needs"))
    listed = told.groupBy("term", "bundle").agg(F.sort_array(F.collect_list(of)).alias("of"))
    return listed.select(
        "term", "bundle", *(F.col(f"of.{name}").alias(f"of_{name}") for name in ("slots", "weights", "begins", "needs"))
    )


def _nth_best(carried: DataFrame, top: int) -> DataFrame:
    """The score that is ``top``-th so far, of the items that have so many."""
    scores = carried.select("bundle", F.explode("best").alias("b")).select("bundle", "b.slot", "b.score")
    ordered = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"))
    placed = scores.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") == top)
    return placed.select("bundle", "slot", F.col("score").alias("least"))


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    cuts: tuple[int, ...] = CUTS,
    block_docs: int = BLOCK_DOCS,
    block_postings: int = BLOCK_POSTINGS,
    bundle_items: int = BUNDLE_ITEMS,
    bitmap_bytes: int = BITMAP_BYTES,
) -> DataFrame:
    """Per item its ``top`` best documents of score above 0: item id, ``rank``, document id, ``score``."""
    spark = docs.sparkSession
    terms = item_terms(items, item_col, item_text_col, bundle_items)
    index = build_index(docs, id_col, text_col, bitmap_of(terms, bitmap_bytes), block_docs, block_postings)
    blocks = index.where("term IS NULL").select("block", "n_docs", "n_terms", "ids")
    totals = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = totals["docs"] or 0, totals["terms"] or 0
    of_term = weighed_terms(index, terms, n_docs, cuts)

    postings = index.where("term IS NOT NULL").select("block", "term", "places", "times", "lengths")
    owned = _with_shares(postings.join(of_term.select("term", "owner"), "term"), n_docs, max(n_terms, 1))
    path = scratch_path(spark, "owners")
    owned.write.partitionBy("owner").parquet(path)
    owned = spark.read.schema(owned.schema).parquet(path)

    weights = materialise(terms.join(of_term, "term"), "item-weights")
    carried = spark.createDataFrame([], _CARRIED)
    least = spark.createDataFrame([], "bundle int, slot int, least long")
    for owner in range(len(cuts) + 1):
        sent = owned.where(F.col("owner") == owner).drop("owner").join(_told(weights, least, owner), "term")
        stage = (
            carried.select(*_NAMES[:5])
            .groupBy("bundle", "block")
            .cogroup(sent.drop("term").groupBy("bundle", "block"))
            .applyInArrow(_add(top, owner == len(cuts)), _CARRIED)
        )
        carried = materialise(stage, "accumulators")
        least = materialise(_nth_best(carried, top), "thresholds") if owner < len(cuts) else least

    id_of = F.transform("best", lambda b: F.struct(b["slot"].alias("slot"), b["place"].alias("place"), b["score"].alias("score"), F.get("ids", b["place"]).alias("_doc")))
    found = carried.join(blocks.select("block", "ids"), "block").select("bundle", "block", F.explode(id_of).alias("f"))
    found = found.select("bundle", "block", "f.*").join(terms.select("bundle", "slot", "_item", "_id").distinct(), ["bundle", "slot"])
    ordered = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("_doc"), "block", "place")
    ranked = found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= top)
    return ranked.select(F.col("_id").alias(item_col), "rank", F.col("_doc").alias(id_col), "score")
