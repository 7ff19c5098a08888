"""Spelling variants of words, joined by asymmetric q-chunks.

Words are maximal runs of letters in whole texts, ASCII letters lower-cased, with at
least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences.  Two words are near if
one inserted, deleted or replaced code point turns one into the other.

*Join.*  Of two near words the shorter (either, if they are of one length) contributes
its two disjoint *chunks*, the lower and the upper half of its code points; the other
contributes its positional *grams* of the lengths of such chunks.  One edit leaves one of
the two chunks as it is, and the gram equal to it begins at the chunk's place or one after
it.  The grams at all other places can match no chunk within that shift and are not sent.
So an equi-join on the chunk, its half and the shorter word's length finds each near pair.

*Hot groups.*  Many words may share a half.  A group of more than ``GROUP`` pairs of chunk
and gram is not joined: all its words agree on the chunk, so what is left of them must be
near by itself, and the *rests* go through the same step, keyed by the chunk too.  With
every step the rest halves; when one code point is left of the shorter word, the group's
words agree on all others, and their number is bounded by the alphabet.  So no word is
left out, and no group lists the pairs of words that merely share a part.

*Verification* by Levenshtein distance of the whole words.

*Forms.*  A word's form is its near word of most occurrences (of these the first in
code-point order) if it has at least ``RATIO`` times the word's own.  Counts grow along
forms by that factor, so they have no cycles, and the last one, the root, is found by
doubling steps whose number follows from the largest count.

Nulls: null texts have no words; a null id is written as nothing before the colon of what
is hashed.  Repeated rows count as often as they are there.  Empty tables have no words.
Very long runs are words like others.  Other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: One run of a document in so many loses a code point (0: none does).
SLIPS = 199
#: Pairs of chunk and gram that a group is joined at.
GROUP = 1024
#: Bytes of words that a task counts before it hands its counts on.
FLUSH_BYTES = 8 << 20
#: ASCII lower-case letters and U+00C0 to U+00FF, in UTF-8.
_LETTER = rb"(?:[a-z]|\xc3[\x80-\xbf])"


def slipped(run: bytes, prefix: int, slips: int) -> bytes:
    """The run, without one code point if its hash, after the hash of what precedes it, says so."""
    h = zlib.crc32(run, prefix)
    if h % slips:
        return run
    text = run.decode()
    place = h % len(text)
    return (text[:place] + text[place + 1 :]).encode()


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slips: int = SLIPS,
    flush_bytes: int = FLUSH_BYTES,
) -> DataFrame:
    """Columns ``word`` and ``n`` of the words of all texts.

    A run loses a code point if ``slips`` divides the CRC-32 of its id, a colon and the run.
    """
    # Shorter runs stay too short whatever they lose.
    runs = re.compile(_LETTER + b"{%d,}" % min_length)
    given = docs.select(
        F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("prefix"),
        F.encode(text_col, "UTF-8").alias("text"),
    ).where("text IS NOT NULL")

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([word.decode() for word in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        size = 0
        for batch in batches:
            for prefix, text in zip(batch.column(0), batch.column(1)):
                own = Counter(runs.findall(text.as_py().lower()))
                if slips:
                    before = zlib.crc32(prefix.as_buffer())
                    for word in [word for word in own if not zlib.crc32(word, before) % slips]:
                        total[slipped(word, before, slips)] += own.pop(word)
                known = len(total)
                total.update(own)
                # New words are about as long as the document's others.
                size += (len(total) - known) * (100 + sum(map(len, own)) // max(1, len(own)))
                if size > flush_bytes:
                    yield out(total)
                    total, size = Counter(), 0
        yield out(total)

    counted = given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.char_length("word") >= min_length))


def _signatures(rests: DataFrame, side: str) -> DataFrame:
    """Keys of chunks or grams of each word's rest (``word``, ``key``, ``start``, ``rest``: code points left).

    Halves are cut by the length of the shorter word (``short``): ``half`` 0 is its lower
    part and leaves the upper one as the next rest, 1 the other way round.  ``last`` marks
    rests of one code point: they have no lower half, and all words of their key are compared.
    """
    # The other word is as long as the shorter one or one code point longer.
    lengths = F.array("rest") if side == "chunk" else F.array("rest", F.col("rest") - 1)
    cut = (
        rests.withColumn("short", F.explode(lengths))
        .where("short >= 1")
        .withColumn("lower", F.expr("short div 2"))
        .withColumn("upper", F.expr("short - lower"))
        .withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
        .where("lower > 0 OR half = 0")
    )
    is_lower = F.col("half") == 0
    size = F.when(is_lower, F.col("lower")).otherwise(F.col("upper"))
    place = F.col("start") + F.when(is_lower, 0).otherwise(F.col("rest") - F.col("upper"))
    return cut.select(
        "word",
        F.xxhash64("key", "short", "half", F.substring("word", place + 1, size)).alias("key"),
        (F.col("start") + F.when(is_lower, size).otherwise(0)).alias("start"),
        (F.col("rest") - size).alias("rest"),
        (F.col("short") == 1).alias("last"),
    )


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """Columns ``x`` and ``y``: every pair of distinct words one edit apart, once in each order.

    ``words`` has a column ``word`` of distinct values, of two code points at least.
    """
    whole = words.select(
        "word", F.lit(0).cast("long").alias("key"), F.lit(0).alias("start"), F.char_length("word").alias("rest")
    )
    chunks, grams = whole, whole
    pairs = None
    while True:
        chunks = materialise(_signatures(chunks, "chunk"), "chunks")
        grams = materialise(_signatures(grams, "gram"), "grams")
        sizes = (
            chunks.select("key", "last", F.lit(1).alias("c"), F.lit(0).alias("g"))
            .union(grams.select("key", "last", F.lit(0), F.lit(1)))
            .groupBy("key")
            .agg(F.sum("c").alias("c"), F.sum("g").alias("g"), F.max("last").alias("last"))
            .where("c > 0 AND g > 0")
        )
        hot = (F.col("c") * F.col("g") > group) & ~F.col("last")
        sizes = materialise(sizes.select("key", hot.alias("hot")), "groups")
        cool = sizes.where("NOT hot").select("key")
        left = chunks.join(cool, "key", "left_semi").select("key", F.col("word").alias("x"))
        right = grams.join(cool, "key", "left_semi").select("key", F.col("word").alias("y"))
        found = left.join(right, "key").where(_one_edit(F.col("x"), F.col("y"))).select("x", "y")
        pairs = found if pairs is None else pairs.union(found)
        hot_keys = sizes.where("hot").select("key")
        if hot_keys.isEmpty():
            break
        chunks = chunks.join(hot_keys, "key", "left_semi")
        grams = grams.join(hot_keys, "key", "left_semi")
    return pairs.union(pairs.select("y", "x")).distinct()


def _one_edit(x: Column, y: Column) -> Column:
    # Words of one length meet from both sides.
    return ((F.char_length(x) < F.char_length(y)) | (x < y)) & (F.levenshtein(x, y, 1) == 1)


def roots(forms: DataFrame, largest: int, ratio: int = RATIO) -> DataFrame:
    """Columns ``word`` and ``root``, the last of the forms, from ``word`` and ``form`` (null for none).

    ``largest`` is the most occurrences of a word; each form has ``ratio`` times its word's.
    """
    steps = math.ceil(math.log(max(largest, 2), ratio)) + 1
    reached = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(steps)))):
        reached = materialise(reached, "roots")
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        reached = reached.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return forms.select("word").join(reached, "word", "left").select("word", F.coalesce("root", "word").alias("root"))


def group_variants(counted: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """Per word: ``word``, ``n``, ``form``, ``form_n``, ``root``, ``n_near``, from ``word`` and ``n``."""
    if ratio < 2:
        raise ValueError("counts must grow along forms")
    words = materialise(counted.select("word", "n"), "words")
    near = materialise(near_words(words, group), "near")
    of_near = words.select(F.col("word").alias("y"), F.col("n").alias("near_n"))
    best = (
        near.join(of_near, "y")
        .groupBy(F.col("x").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("y"))).alias("best"))
    )
    more = -F.col("best.minus_n") >= ratio * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word",
        "n",
        F.when(more, F.col("best.y")).alias("form"),
        F.when(more, -F.col("best.minus_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
    forms = materialise(forms, "forms")
    largest = forms.agg(F.max("n").alias("n")).first()["n"] or 0
    return forms.join(roots(forms, largest, ratio), "word").select("word", "n", "form", "form_n", "root", "n_near")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Words of all texts with their forms and roots; ``options`` are those of ``count_words``."""
    return group_variants(count_words(docs, id_col, text_col, **options))
