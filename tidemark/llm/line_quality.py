r"""Line-first cleaning: rules on lines, then a verdict on what they leave.

Every ``\n``-split line is judged by itself:

* punctuation: symbols or exclamation marks pile up, or a long line has letters
  without lower case;
* navigation: the line is a list of short entries between separators;
* boilerplate: the line holds a fixed phrase of web pages, or repeats an earlier
  line of the text.

Failed lines are removed.  A document is rejected if its base rules fail or if
fewer than ``min_kept_share`` of its words are left.  Lines are never failed for
a missing full stop alone: headings, code and licence lines of clean documents
have none.

Null texts count as empty: no words, base rules failed, not kept.  Rows are
independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_SEPARATORS = re.compile(r"[|»›•·]|(?: [-/>] )")
# Fixed phrases of web pages, in lower case.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "javascript is disabled",
    "privacy policy",
    "share on facebook",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "use of cookies",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict."""

    symbols_per_word: float = 0.3
    exclamations_per_word: float = 0.3
    upper_words: int = 5
    separators: int = 3
    words_per_entry: float = 4.0
    boilerplate_words: int = 40
    min_kept_share: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


def line_fails(line: str, words: list[str], rules: LineRules = LineRules()) -> str | None:
    """The rule that a line with words breaks, if any."""
    n = len(words)
    if sum(map(line.count, SYMBOLS)) > rules.symbols_per_word * n:
        # A list between bars is navigation, all else that is full of symbols is junk.
        return "navigation" if line.count("|") >= rules.separators else "punctuation"
    if line.count("!") > rules.exclamations_per_word * n and n >= rules.upper_words:
        return "punctuation"
    if n >= rules.upper_words and line.isupper():
        return "punctuation"
    entries = len(_SEPARATORS.findall(line))
    if entries >= rules.separators and n <= rules.words_per_entry * (entries + 1):
        return "navigation"
    if n <= rules.boilerplate_words and _BOILERPLATE.search(line.lower()):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first time included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(word, len(ids)) for word in words), np.int64, n)
    _, pairs = np.unique(x[:-1] * len(ids) + x[1:], return_inverse=True)
    _, where, counts = np.unique(pairs[:-1] * len(ids) + x[2:], return_inverse=True, return_counts=True)
    repeated = counts[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= repeated
    return int(covered.sum())


def judge(text: str, rules: LineRules = LineRules()) -> dict:
    """All figures of one text and its verdict."""
    words = text.encode().split()
    n_words = len(words)
    n_dup_lines = words_left = lines_removed = 0
    seen: set[str] = set()
    for line in text.split("\n"):
        # bytes split at the ASCII blanks only
        own = line.encode().split()
        if not own:
            continue
        if line in seen:
            n_dup_lines += 1
            lines_removed += 1
            continue
        seen.add(line)
        if line_fails(line, own, rules):
            lines_removed += 1
        else:
            words_left += len(own)
    n_repeat = repeated_words(words)
    base_failed = n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n_words
    return {
        "n_words": n_words,
        "word_chars": len(text) - sum(map(text.count, BLANKS)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": not base_failed and words_left >= rules.min_kept_share * n_words,
        "lines_removed": lines_removed,
        "words_left": words_left,
    }


def clean_text(text: str, rules: LineRules = LineRules()) -> str:
    """The text without its failed lines."""
    seen: set[str] = set()
    kept = []
    for line in text.split("\n"):
        own = line.encode().split()
        if own and (line in seen or line_fails(line, own, rules)):
            continue
        if own:
            seen.add(line)
        kept.append(line)
    return "\n".join(kept)


_FIGURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "lines_removed": pa.int64(),
    "words_left": pa.int64(),
}


def line_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: LineRules = LineRules(),
    with_text: bool = False,
) -> DataFrame:
    """Figures and verdict of every text; ``with_text`` adds the ``clean_text``."""
    figures = [T.StructField(name, T.BooleanType() if kind == pa.bool_() else T.LongType()) for name, kind in _FIGURES.items()]
    if with_text:
        figures.append(T.StructField("clean_text", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            judged = [judge(text, rules) for text in texts]
            columns = [pa.array([row[name] for row in judged], kind) for name, kind in _FIGURES.items()]
            if with_text:
                columns.append(pa.array([clean_text(text, rules) for text in texts], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *(field.name for field in figures)])

    return docs.select(id_col, text_col).mapInArrow(run, T.StructType([docs.schema[id_col], *figures]))
