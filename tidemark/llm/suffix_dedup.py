"""Removal of repeated byte strings by a column-wise multi-document suffix order.

All strings of a block are worked on together, a column from the right per round:
every string that has a byte in the column inserts it.  The suffixes that begin
in a column stand in the order of their bytes; the order for the next column
follows from the Burrows-Wheeler transform of this one alone, the bytes in front
of the suffixes in their order: sorted stably by them, the suffixes stand in the
order that they have with the byte prepended.  The common prefixes of neighbours
are updated in the same round: one more than the least between the places where
two neighbours stood before, or none if their new bytes differ.  Neighbours that
share 50 bytes or more form a group of equal strings, and the smallest document
of a group keeps its copy.

The strings are the pieces of documents that can hold a repeat (see ``repeats``).
Equal 50-byte strings have their anchor at the same distance, so with the anchors
of all pieces in one column they begin in the same column, and a round needs the
suffixes of one column only, of which there is one per string.  A round reads and
writes its arrays from end to end.  What would be external files are the blocks,
which come and go through Spark's shuffle; a block's arrays are a few times its
size.

Null texts are empty.  Strings never cross documents.  Rows that repeat an id do
not remove one another's bytes; a null id ranks after all others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import repeats

WINDOW = 50
GRAM = 16


class _RangeMin:
    """Least value between any two places of an array."""

    def __init__(self, values: np.ndarray):
        levels, span = [values], 1
        while 2 * span <= len(values):
            last = levels[-1].copy()
            last[: len(values) - span] = np.minimum(levels[-1][:-span], levels[-1][span:])
            levels.append(last)
            span *= 2
        self.levels = np.stack(levels)

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value at the places from ``first`` to ``last``, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        return np.minimum(self.levels[level, first], self.levels[level, last - (1 << level) + 1])


class Columns:
    """The suffixes of one column in order, and the common prefixes of neighbours.

    ``first`` and ``end`` are the columns where each string begins and ends
    (exclusive); ``base`` is where column 0 of it is in ``data``.
    """

    def __init__(self, data: np.ndarray, base: np.ndarray, first: np.ndarray, end: np.ndarray, longest: int):
        self.data, self.base, self.first, self.end = data, base, first, end
        self.longest = longest  # common prefixes count up to here
        self.order = np.zeros(0, np.int64)
        self.common = np.zeros(0, np.uint8)  # of a suffix and the one before it
        by_end = np.argsort(end, kind="stable")
        self.ending = {int(e): by_end[i:j] for e, i, j in zip(*_stretches(end[by_end]))}

    def step(self, column: int) -> None:
        """From the suffixes that begin behind ``column`` to those that begin in it."""
        stay = np.flatnonzero(self.first[self.order] <= column)
        if len(stay) < len(self.order):
            # A string that began further right leaves; its neighbours share what both shared with it.
            common = self.common[: stay[-1] + 1] if len(stay) else self.common[:0]
            self.common = np.minimum.reduceat(common, np.append(0, stay[:-1] + 1)) if len(stay) else common
            self.order = self.order[stay]
        # Strings that end here come in as empty suffixes, before all others.
        coming = self.ending.get(column + 1, np.zeros(0, np.int64))
        order = np.concatenate([coming, self.order])
        common = np.concatenate([np.zeros(len(coming), np.uint8), self.common])
        common[len(coming) : len(coming) + 1] = 0
        if not len(order):
            return
        front = self.data[self.base[order] + column]
        place = np.argsort(front, kind="stable")
        self.order = order[place]
        self.common = np.zeros(len(order), np.uint8)
        same = np.flatnonzero(front[place[1:]] == front[place[:-1]])
        shared = _RangeMin(common).between(place[same] + 1, place[same + 1])
        self.common[same + 1] = np.minimum(shared, self.longest - 1) + 1


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and ends of the stretches of equal values."""
    cuts = np.flatnonzero(np.diff(values, prepend=values[0] - 1, append=values[-1] + 1)) if len(values) else np.zeros(1, np.int64)
    return values[cuts[:-1]], cuts[:-1], cuts[1:]


def parse(pieces: list[bytes], ids: np.ndarray, anchors: np.ndarray, window: int) -> np.ndarray:
    """Bits per piece: which of its windows start in a piece of a smaller document too."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(piece) for piece in pieces])
    first, end = -anchors, lengths - anchors
    columns = Columns(data, np.cumsum(lengths) - lengths + anchors, first, end, window)
    bits = np.zeros(len(pieces), np.uint64)
    for column in range(int(end.max()) - 1, int(first.min()) - 1, -1):
        columns.step(column)
        order = columns.order
        if column + window > int(end.max()) or not len(order):
            continue
        heads = np.flatnonzero(columns.common < window)
        least = np.minimum.reduceat(ids[order], heads)
        repeated = ids[order] > np.repeat(least, np.diff(np.append(heads, len(order))))
        repeated = order[repeated & (column + window <= end[order])]
        bits[repeated] |= np.uint64(1) << (column - first[repeated]).astype(np.uint64)
    return bits


def _finish(names: list[str], keep: tuple[str, ...], with_text: bool):
    def run(table: pa.Table, spans: list[np.ndarray]) -> pa.Table:
        n_bytes, n_removed, digests, texts = [], [], [], []
        for text, stretches in zip(table.column("_text").to_pylist(), spans):
            at, kept = 0, []
            for start, end in stretches.tolist():
                kept.append(text[at:start])
                at = end
            kept.append(text[at:])
            left = b"".join(kept)
            n_bytes.append(len(text))
            n_removed.append(len(text) - len(left))
            digests.append(hashlib.sha256(left).hexdigest())
            # A string may end inside a character; what is left of it goes.
            texts.append(left.decode(errors="ignore"))
        columns = [
            table.column("_id"),
            pa.array(n_bytes, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array([s.tolist() for s in spans], pa.list_(pa.list_(pa.int64()))),
            pa.array(digests, pa.string()),
            *([pa.array(texts, pa.string())] if with_text else []),
            *(table.column(name) for name in keep),
        ]
        return pa.Table.from_arrays(columns, names)

    return run


def remove_strings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    keep_cols: tuple[str, ...] = (),
    with_text: bool = False,
    **sizes: int,
) -> DataFrame:
    """Per document ``n_bytes``, ``n_removed``, ``n_spans``, the removed ``spans`` (first byte, last exclusive), ``kept_sha256``.

    ``with_text`` adds what is left as ``kept_text``; ``sizes`` go to ``remove_repeats``.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept_sha256", T.StringType()),
            *([T.StructField("kept_text", T.StringType())] if with_text else []),
            *(docs.schema[name] for name in keep_cols),
        ]
    )
    finish = _finish(schema.names, keep_cols, with_text)
    shape = repeats.Shape("bytes", window, min(gram, window))
    done = repeats.remove_repeats(docs, shape, parse, finish, schema, id_col, text_col, keep_cols, **sizes)
    return done.withColumn("n_spans", F.size("spans").cast("long"))
