"""Windows that start in a document with a smaller id, whatever the size of the table.

A window is a fixed number of consecutive units (words or bytes) of one document.
The first of the short grams inside it with the least hash is its *anchor*, the
hash its *key*: equal windows have equal keys and anchors at the same distance.
Neighbouring windows mostly share an anchor: the windows of one anchor are a *run*,
and their units are a *piece*.

1. Homes take a census of the keys (``census``): only runs whose key occurs in
   more than one document can hold a repeated window.
2. A home settles pieces that are equal among its own documents, and sends one of
   each to the *block* of its key.  All equal windows meet in one block.
3. A block settles equal pieces of different homes and gives the rest, each with
   the smallest id that has it, to a *parser*, which says of each window of each
   piece whether a piece of a smaller id has it too.
4. Homes are told, add up the covered units, and finish their documents.

A key with very many different pieces (``HOT_PIECES``) would make a block too
large: its runs are cut into single windows with the window's own hash as key, of
which only equal ones meet.  Ids must be integers; a null id ranks after all
others.  Equal ids never remove one another's windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import census, hashing

SLAB_UNITS = 1 << 17
#: Slabs and slices are shorter than 2**24 units.
_PLACES = np.uint64((1 << 24) - 1)
#: Windows per run: as many as there are bits in an answer.
MAX_RUN = 64
HOT_PIECES = 50_000
BLOCK_BYTES = 1 << 20
_WORD_BYTES = 6


@dataclass(frozen=True)
class Shape:
    """Size of windows and of the grams that key them, in units."""

    unit: str  # "words" or "bytes"
    window: int
    gram: int


@dataclass
class Runs:
    """Runs of a home, one array element each; places are relative to the document."""

    doc: np.ndarray
    first: np.ndarray  # unit of the first window
    windows: np.ndarray
    key: np.ndarray
    mark_a: np.ndarray  # hash of the piece
    mark_b: np.ndarray
    byte_start: np.ndarray
    byte_end: np.ndarray
    anchor: np.ndarray  # units from the first window to the anchor

    def take(self, index: np.ndarray) -> Runs:
        return Runs(*(getattr(self, f.name)[index] for f in fields(self)))

    @staticmethod
    def joined(parts: list[Runs]) -> Runs:
        kinds = [np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64]
        return Runs(
            *(
                np.concatenate([getattr(part, f.name) for part in parts]) if parts else np.zeros(0, kind)
                for f, kind in zip(fields(Runs), kinds)
            )
        )


def units_of(data: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and ends of the units of a text."""
    if unit == "bytes":
        places = np.arange(len(data) + 1)
        return hashing.byte_values(data), places[:-1], places[1:]
    starts, ends = hashing.words(data)
    return hashing.stretches(hashing.byte_values(data), starts, ends), starts, ends


def _runs_in(shape: Shape, values, starts, ends, docs: np.ndarray, bounds: np.ndarray, single: np.ndarray | None) -> Runs:
    """Runs of the documents whose units lie between ``bounds``; places still count from the slab's start.

    ``single`` marks windows that are to be runs of their own, keyed by their own hash.
    """
    n = len(values) - shape.window + 1
    if n <= 0:
        return Runs.joined([])
    grams = hashing.grams(values, shape.gram)
    # The place in the lower bits makes the first of equal grams the least.
    placed = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
    anchors = (hashing.sliding_min(placed, shape.window - shape.gram + 1) & _PLACES).astype(np.int64)
    # Only windows inside one document count.
    owner = np.repeat(np.arange(len(docs)), np.diff(bounds))[:n]
    inside = np.arange(n) + shape.window <= bounds[1:][owner]
    at = np.flatnonzero(inside)
    if not len(at):
        return Runs.joined([])
    anchor, of = anchors[at], owner[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])
    if single is not None:
        cut = single[: len(at)]
        new[cut] = True
        new[1:] |= cut[:-1]
    begin = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(since % MAX_RUN == 0)
    count = np.diff(np.append(begin, len(at)))
    first = at[begin]
    last = first + count - 1 + shape.window
    runs = Runs(
        docs[of[begin]],
        first,
        count,
        grams[anchor[begin]],
        hashing.stretches(values, first, last),
        hashing.stretches(values, first, last, 1),
        starts[first],
        ends[last - 1],
        anchor[begin] - first,
    )
    if single is not None:
        runs.key = np.where(cut[begin], hashing.mixed(runs.mark_a ^ np.uint64(0x5851F42D4C957F2D)), runs.key)
    return runs


def runs_of(texts: list[bytes], shape: Shape, hot: Callable[[np.ndarray], np.ndarray] | None = None) -> Runs:
    """All runs of a home's texts; ``hot`` says which keys' runs are cut into single windows."""
    parts: list[Runs] = []
    waiting: list[int] = []
    size = 0

    def flush() -> None:
        between = b"" if shape.unit == "bytes" else b"\n"
        data = np.frombuffer(between.join(texts[i] for i in waiting), np.uint8)
        values, starts, ends = units_of(data, shape.unit)
        lengths = np.array([len(texts[i]) + len(between) for i in waiting])
        text_start = np.concatenate([[0], np.cumsum(lengths)])
        bounds = text_start if shape.unit == "bytes" else np.searchsorted(starts, text_start)
        docs = np.array(waiting)
        # Slices of long texts overlap by all but one unit of a window.
        step = 8 * SLAB_UNITS
        for a in range(0, max(len(values) - shape.window + 1, 0), step):
            b = min(len(values), a + step + shape.window - 1)
            found = cut_runs(values[a:b], starts[a:b], ends[a:b], docs, np.clip(bounds, a, b) - a)
            index = np.searchsorted(docs, found.doc)
            found.first += a - bounds[index]
            found.byte_start -= text_start[index]
            found.byte_end -= text_start[index]
            parts.append(found)

    def cut_runs(values, starts, ends, docs, bounds) -> Runs:
        runs = _runs_in(shape, values, starts, ends, docs, bounds, None)
        if hot is not None and len(runs.key):
            cut = hot(runs.key)
            if cut.any():
                runs = _runs_in(shape, values, starts, ends, docs, bounds, np.repeat(cut, runs.windows))
        return runs

    for i, text in enumerate(texts):
        if len(text) < shape.window:
            continue
        waiting.append(i)
        size += len(text)
        if size >= SLAB_UNITS:
            flush()
            waiting, size = [], 0
    if waiting:
        flush()
    return Runs.joined(parts)


def _distinct(runs: Runs, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal pieces the one with the smallest id: its index, in order; for each run, which it is; whether a run is later."""
    id_of = ids[runs.doc]
    order = np.lexsort((runs.first, runs.doc, id_of, runs.mark_b, runs.mark_a, runs.key))
    k, a, b = runs.key[order], runs.mark_a[order], runs.mark_b[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    chosen = order[new]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return chosen, which, id_of > id_of[chosen][which]


def count_keys(shape: Shape, buckets: int) -> Callable[[int, pa.Table], pa.Table]:
    """Tag messages of a home: each key with its number of different pieces, or 2 if several documents share one."""

    def run(home: int, table: pa.Table) -> pa.Table:
        runs = runs_of(table.column("_text").to_pylist(), shape)
        if not len(runs.key):
            return census.empty_message()
        order = np.lexsort((runs.doc, runs.mark_a, runs.key))
        key, mark, doc = runs.key[order], runs.mark_a[order], runs.doc[order]
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_mark = new_key.copy()
        new_mark[1:] |= mark[1:] != mark[:-1]
        new_doc = np.zeros(len(key), bool)
        new_doc[1:] = doc[1:] != doc[:-1]
        at = np.flatnonzero(new_key)
        pieces = np.add.reduceat(new_mark.astype(np.int64), at)
        several = np.add.reduceat((new_doc & ~new_key).astype(np.int64), at) > 0
        return census.tags(home, key[at], np.where(several, np.maximum(pieces, 2), 1), buckets)

    return run


class _Home:
    """The runs of a home that may repeat, and those of them that stand for their equals."""

    def __init__(self, shape: Shape, buckets: int, blocks: int, table: pa.Table, answers: pa.Table):
        self.texts = table.column("_text").to_pylist()
        self.ids = census.ids_of(table)
        plain = runs_of(self.texts, shape)
        keys = np.unique(plain.key)
        verdict = census.verdicts(keys, buckets, census.of_kind(answers, "verdict"))

        def told(wanted: np.ndarray) -> np.ndarray:
            return verdict[np.searchsorted(keys, wanted)]

        shared = told(plain.key) if len(keys) else np.zeros(0, np.uint8)
        if (shared == census.HOT).any():
            # Cut before the lone runs go: the cut runs have keys of their own.
            cut = runs_of(self.texts, shape, lambda key: told(key) == census.HOT)
            known = np.isin(cut.key, keys)
            keep = ~known
            keep[known] = told(cut.key[known]) == census.SHARED
            self.runs = cut.take(np.flatnonzero(keep))
        else:
            self.runs = plain.take(np.flatnonzero(shared != census.LONE))
        self.chosen, self.which, self.later = _distinct(self.runs, self.ids)
        block = (hashing.mixed(self.runs.key[self.chosen]) % np.uint64(blocks)).astype(np.int64)
        self.order = np.argsort(block, kind="stable")
        block = block[self.order]
        cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        self.parts = [(int(block[i]), i, j) for i, j in zip(cuts[:-1], cuts[1:])] if len(block) else []


def parse_blocks(shape: Shape, parse: Callable) -> Callable[[tuple, pa.Table], pa.Table]:
    """For a block: which windows of each home's pieces a smaller id has too, as bits."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        # Equal pieces are settled first; of each the smallest id goes on.
        numbers: dict[bytes, int] = {}
        piece_no, ids, anchors = [], [], []
        for data, length, doc, anchor in zip(*(table.column(name) for name in "abcd")):
            raw, at = data.as_py(), 0
            for n in np.frombuffer(length.as_py(), np.uint32).tolist():
                piece_no.append(numbers.setdefault(raw[at : at + n], len(numbers)))
                at += n
            ids.append(np.frombuffer(doc.as_py(), np.int64))
            anchors.append(np.frombuffer(anchor.as_py(), np.uint16))
        piece_no, all_ids = np.array(piece_no), np.concatenate(ids)
        least = np.full(len(numbers), np.iinfo(np.int64).max)
        np.minimum.at(least, piece_no, all_ids)
        # Equal pieces have their anchor at the same place.
        anchor_of = np.zeros(len(numbers), np.int64)
        anchor_of[piece_no] = np.concatenate(anchors)
        bits = parse(list(numbers), least, anchor_of, shape.window)
        answer = np.where(all_ids > least[piece_no], np.uint64(0xFFFFFFFFFFFFFFFF), bits[piece_no])
        ends = np.cumsum([len(x) for x in ids])
        homes = table.column("_home").to_pylist()
        part = key[0].as_py()
        return census.message(
            [(home, "marks", part, answer[end - len(x) : end]) for home, end, x in zip(homes, ends, ids)]
        )

    return run


def covered(shape: Shape, home: _Home, answers: pa.Table) -> list[np.ndarray]:
    """For each document of a home, pairs of first and last unit (exclusive) of its repeated stretches."""
    marks = np.zeros(len(home.chosen), np.uint64)
    by_part = dict(zip(answers.column("part").to_pylist(), answers.column("a").to_pylist()))
    for part, i, j in home.parts:
        marks[home.order[i:j]] = np.frombuffer(by_part[part], np.uint64)
    runs = home.runs
    bits = np.where(home.later, np.uint64(0xFFFFFFFFFFFFFFFF), marks[home.which])
    hit = np.flatnonzero(bits)
    number = np.arange(MAX_RUN)
    flags = (bits[hit, None] >> number.astype(np.uint64)) & np.uint64(1) > 0
    flags &= number < runs.windows[hit, None]
    row, shift = np.nonzero(flags)
    first = runs.first[hit[row]] + shift
    doc = runs.doc[hit[row]]
    order = np.lexsort((first, doc))
    first, doc = first[order], doc[order]
    new = np.ones(len(first), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (first[1:] > first[:-1] + shape.window)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(first)) - 1
    spans = np.stack([first[begin], first[end] + shape.window], axis=1) if len(begin) else np.zeros((0, 2), np.int64)
    place = np.searchsorted(doc[begin], np.arange(len(home.texts) + 1))
    return [spans[i:j] for i, j in zip(place[:-1], place[1:])]


def remove_repeats(
    docs: DataFrame,
    shape: Shape,
    parse: Callable,
    finish: Callable[[pa.Table, list[np.ndarray]], pa.Table],
    schema,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_cols: tuple[str, ...] = (),
    hot_pieces: int = HOT_PIECES,
    home_bytes: int = census.HOME_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``finish`` of every home's rows and the repeated stretches of each.

    ``parse(pieces, ids, anchors, window)`` gets the different pieces of a block, the smallest id
    and the anchor's unit of each, and returns a bit per window, set where a piece with a smaller
    id has the window.
    """
    n_homes = census.parts_for(docs, text_col, home_bytes)
    # Pieces overlap, so that together they can be a few times the text.
    n_blocks = max(1, n_homes * home_bytes // block_bytes)
    homes = census.at_home(docs, id_col, text_col, keep_cols, n_homes)
    # One gram of those that a window spans is its key, on average every half window.
    bytes_per_key = (shape.window - shape.gram + 2) * (_WORD_BYTES if shape.unit == "words" else 1) // 2
    n_buckets = census.buckets_for(n_homes, home_bytes, bytes_per_key)
    answers = census.take_census(homes, count_keys(shape, n_buckets), hot_pieces)

    def send(home: int, table: pa.Table, told: pa.Table) -> pa.Table:
        own = _Home(shape, n_buckets, n_blocks, table, told)
        runs, rows = own.runs, []
        for part, i, j in own.parts:
            chosen = own.chosen[own.order[i:j]]
            doc, start, end = runs.doc[chosen], runs.byte_start[chosen], runs.byte_end[chosen]
            pieces = b"".join(own.texts[d][s:e] for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist()))
            sizes, anchors = (end - start).astype(np.uint32), runs.anchor[chosen].astype(np.uint16)
            rows.append((home, "pieces", part, pieces, sizes, own.ids[doc], anchors))
        return census.message(rows)

    pieces = census.with_answers(homes, answers, send, census.MESSAGE)
    marks = pieces.groupBy("part").applyInArrow(parse_blocks(shape, parse), census.MESSAGE)

    def end(_: int, table: pa.Table, told: pa.Table) -> pa.Table:
        own = _Home(shape, n_buckets, n_blocks, table, told)
        done = finish(table, covered(shape, own, census.of_kind(told, "marks")))
        return done.append_column("_copies", table.column("_copies"))

    counted = T.StructType([*schema.fields, T.StructField("_copies", T.LongType())])
    return census.repeated(census.with_answers(homes, answers.unionByName(marks), end, counted))
