"""Token counts by a public tokenizer, computed in Arrow batches that return lengths only.

Texts are cut at safe boundaries, the distinct pieces of an Arrow batch that the
worker has not met yet are encoded in batches of about ``batch_bytes`` bytes, and
the lengths of its pieces add up to that of a text.  A boundary is safe for a
byte-level vocabulary whose pattern takes at most one blank before a word: no
token crosses the place before a single space, or around a single line feed,
between two characters that are not white space.

* A text with single spaces and line feeds only is cut at all of them, so that
  its pieces are words, of which each is encoded once.
* Any other text is cut before a space between two letters or digits wherever a
  piece is longer than ``piece_chars``; without such a place it stays whole.

A worker remembers at most ``memory`` words.  Null and empty texts have 0 bytes
and 0 tokens.  Rows are independent: repeated ids give repeated rows, extra
columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 14
MEMORY = 1 << 20
_SAFE_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


def pieces_of(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of at least ``size`` characters (but for the last), cut at safe places."""
    pieces, start = [], 0
    while len(text) - start > size:
        cut = _SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        pieces.append(text[start : cut.start()])
        start = cut.start()
    pieces.append(text[start:])
    return pieces


def load_tokenizer(path: str):
    """A tokenizer file as it is, without truncation or padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Lengths:
    """Token counts of texts, by way of the counts of their pieces."""

    def __init__(self, tokenizer, batch_bytes: int = BATCH_BYTES, piece_chars: int = PIECE_CHARS, memory: int = MEMORY):
        self.tokenizer = tokenizer
        self.batch_bytes = batch_bytes
        self.piece_chars = piece_chars
        self.memory = memory
        self.stop = dict(zip(".,\n", self._encoded([".", ",", "\n"])))
        self.starts: dict[str, int] = {}  # words at the start of a line
        self.inner: dict[str, int] = {}  # words after a space

    def _encoded(self, pieces: list[str]) -> list[int]:
        """Lengths of pieces, encoded in batches of about the same number of bytes."""
        lengths: list[int] = []
        start = waiting = 0
        for i, piece in enumerate(pieces):
            waiting += len(piece.encode())
            if waiting >= self.batch_bytes or i + 1 == len(pieces):
                batch = self.tokenizer.encode_batch_fast(pieces[start : i + 1], add_special_tokens=False)
                lengths += map(len, batch)
                start, waiting = i + 1, 0
        return lengths

    def _learn(self, known: dict[str, int], words: set[str], before: str) -> None:
        if len(known) > self.memory:
            known.clear()
        new = words - known.keys()
        # A letter and a full stop or comma after it are never in one token.
        stopped = [word for word in new if word[-1] in ".," and word[-2:-1].isalpha()]
        whole = sorted((new.difference(stopped) | {word[:-1] for word in stopped}) - known.keys())
        known.update(zip(whole, self._encoded([before + word for word in whole])))
        for word in stopped:
            known[word] = known[word[:-1]] + self.stop[word[-1]]

    def of(self, texts: list[str]) -> list[int]:
        lengths = [0] * len(texts)
        plain: list[tuple[int, list[str], list[str]]] = []
        other: list[str] = []
        owners: list[int] = []
        for i, text in enumerate(texts):
            if text.replace("\n", " ").split(" ") != text.split():
                pieces = pieces_of(text, self.piece_chars)
                other += pieces
                owners += [i] * len(pieces)
            elif text:
                starts, inner = [], []
                for line in text.split("\n"):
                    words = line.split(" ")
                    starts.append(words[0])
                    inner += words[1:]
                plain.append((i, starts, inner))
        self._learn(self.starts, {word for _, starts, _ in plain for word in starts}, "")
        self._learn(self.inner, set().union(*(inner for _, _, inner in plain)), " ")
        for i, starts, inner in plain:
            lengths[i] = (
                sum(map(self.starts.__getitem__, starts))
                + sum(map(self.inner.__getitem__, inner))
                + self.stop["\n"] * (len(starts) - 1)
            )
        for i, length in zip(owners, self._encoded(other)):
            lengths[i] += length
        return lengths


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """Id, ``n_bytes`` and ``n_tokens`` of every text.

    ``tokenizer_path`` is a tokenizer file that every executor has.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        lengths = Lengths(load_tokenizer(tokenizer_path), batch_bytes, piece_chars)
        for batch in batches:
            n_tokens = lengths.of([text or "" for text in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64())], [id_col, "n_bytes", "n_tokens"]
            )

    n_bytes = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    return docs.select(F.col(id_col), F.col(text_col), n_bytes.alias("n_bytes")).mapInArrow(count, schema)
