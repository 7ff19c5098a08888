"""Removal of repeated word passages by relative Lempel-Ziv parsing.

The documents are the reference, in blocks; a block holds the pieces of all
documents whose key (see ``repeats``) it owns, and indexes the 50-word sequences
in them with the smallest document that has each.  A document is parsed greedily
against every block that owns one of its keys: where the index has the next words
in a smaller document, the factor is extended word by word for as long as the two
agree; elsewhere the factor is a single word.  Factors of 50 words or more are
repeated spans.

A greedy factor may end inside a longer agreement with another document, so the
sequences that straddle a factor's end are looked up too; one that is found
starts the next factor there, overlapping.

Words are runs without ASCII blanks, unchanged.  Sequences never cross documents.
Null texts have no words.  Rows that repeat an id do not remove one another's
words; a null id ranks after all others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import hashing, repeats

WINDOW = 50
GRAM = 12


def _block(pieces: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all pieces, where each piece starts, and the piece of each word."""
    data = np.frombuffer(b"\n".join(pieces), np.uint8)
    starts, ends = hashing.words(data)
    lengths = np.array([len(piece) + 1 for piece in pieces])
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    # Words of equal number are equal texts, not only equal hashes.
    numbers: dict[bytes, int] = {}
    raw = data.tobytes()
    words = np.array([numbers.setdefault(raw[s:e], len(numbers)) for s, e in zip(starts.tolist(), ends.tolist())], np.int64)
    return words, bounds, np.repeat(np.arange(len(pieces)), np.diff(bounds))


def index_block(words: np.ndarray, owner: np.ndarray, bounds: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """For the word sequence at each place, a place where the smallest document has it; -1 where none starts."""
    n = len(words) - window + 1
    source = np.full(len(words), -1)
    if n <= 0:
        return source
    values = hashing.mixed(words.astype(np.uint64) + np.uint64(1))
    starts = np.flatnonzero(np.arange(n) + window <= bounds[1:][owner[:n]])
    if not len(starts):
        return source
    a = hashing.stretches(values, starts, starts + window)
    b = hashing.stretches(values, starts, starts + window, 1)
    order = np.lexsort((starts, ids[owner[starts]], b, a))
    a, b = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    source[starts[order]] = starts[order][new][np.cumsum(new) - 1]
    return source


def factors(
    first: int, last: int, words: list[int], source: list[int], found: list[bool], end_of: list[int], window: int
) -> list[tuple[int, int]]:
    """Long factors (start, length) of the piece in ``words[first:last]``."""
    kept = []
    at = first
    while at + window <= last:
        if not found[at]:
            at += 1
            continue
        there = source[at]
        length = window
        while at + length < last and there + length < end_of[there] and words[at + length] == words[there + length]:
            length += 1
        kept.append((at, length))
        # The first sequence over the factor's end that a smaller document has.
        over = range(at + length - window + 1, min(at + length, last - window + 1))
        at = next((place for place in over if found[place]), at + length)
    return kept


def parse(pieces: list[bytes], ids: np.ndarray, anchors: np.ndarray, window: int) -> np.ndarray:
    """Bits per piece: which of its windows lie in a factor from a smaller document."""
    words, bounds, owner = _block(pieces, ids)
    source = index_block(words, owner, bounds, ids, window)
    smaller = (source >= 0) & (ids[owner[np.maximum(source, 0)]] < ids[owner]) if len(words) else np.zeros(0, bool)
    bits = np.zeros(len(pieces), np.uint64)
    word_list, source_list, found = words.tolist(), source.tolist(), smaller.tolist()
    end_of = bounds[1:][owner].tolist()
    for i in np.unique(owner[smaller]).tolist():
        first, last = int(bounds[i]), int(bounds[i + 1])
        for start, length in factors(first, last, word_list, source_list, found, end_of, window):
            for shift in range(start - first, start - first + length - window + 1):
                bits[i] |= np.uint64(1 << shift)
    return bits


def _finish(names: list[str], keep: tuple[str, ...], with_text: bool):
    def run(table: pa.Table, spans: list[np.ndarray]) -> pa.Table:
        n_words, n_removed, digests, texts = [], [], [], []
        for text, stretches in zip(table.column("_text").to_pylist(), spans):
            words = text.split()
            n_words.append(len(words))
            at, kept = 0, []
            for start, end in stretches.tolist():
                kept += words[at:start]
                at = end
            kept += words[at:]
            n_removed.append(len(words) - len(kept))
            left = b" ".join(kept)
            digests.append(hashlib.sha256(left).hexdigest())
            texts.append(left.decode())
        columns = [
            table.column("_id"),
            pa.array(n_words, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array([s.tolist() for s in spans], pa.list_(pa.list_(pa.int64()))),
            pa.array(digests, pa.string()),
            *([pa.array(texts, pa.string())] if with_text else []),
            *(table.column(name) for name in keep),
        ]
        return pa.Table.from_arrays(columns, names)

    return run


def remove_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    keep_cols: tuple[str, ...] = (),
    with_text: bool = False,
    **sizes: int,
) -> DataFrame:
    """Per document ``n_words``, ``n_removed``, the removed ``spans`` (first word, last word exclusive), ``kept_sha256``.

    ``with_text`` adds the kept words joined by a space as ``kept_text``; ``sizes`` go to ``remove_repeats``.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept_sha256", T.StringType()),
            *([T.StructField("kept_text", T.StringType())] if with_text else []),
            *(docs.schema[name] for name in keep_cols),
        ]
    )
    finish = _finish(schema.names, keep_cols, with_text)
    shape = repeats.Shape("words", window, min(gram, window))
    return repeats.remove_repeats(docs, shape, parse, finish, schema, id_col, text_col, keep_cols, **sizes)
