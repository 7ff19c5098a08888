"""Benchmark decontamination by winnowing, in DataFrame operations only.

A *window* is ``span`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window.  Of every window of a document the least hash
of its ``gram``-word grams is kept, with all its places there.  Equal windows have
equal least grams at equal places, so a join of the kept grams of documents and items
misses no window that occurs in both.  A short item's grams are its whole word
sequence, and documents keep all their grams of that many words.

Joined grams are extended: every window of the item around the gram is compared word
by word with the document's words around the place that was joined, so that the work
grows with the joined places.  Words inside equal windows are hit; a hash alone never is.

Only sums reach the driver.  The rows of the item side are broadcast
where they take at most ``broadcast_bytes`` together and joined by a shuffle otherwise.

Null and empty texts have no words.  Rows that repeat a document id are judged
each by its own text, and so are rows with a null document id, which are told apart
by their texts; items that repeat an id count as one item.  A null item id is not
reported among the items, its hits count.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 10
GRAM = 5
BROADCAST_BYTES = 8 << 20
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text_col: str) -> Column:
    """The words of a text, with A-Z in lower case."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Lower case of pure ASCII is that of A-Z; other texts keep their other capitals.
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lower, _SEPARATORS), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and deep inside it is used."""
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _grams(hashes: Column, n: int) -> Column:
    """Hashes of all n-word grams, from the hashes of the words."""
    last = F.size(hashes) - n
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(n)))),
    ).otherwise(F.array().cast("array<bigint>"))


def _short_grams(hashes: Column, n: int) -> Column:
    """Hashes of all n-word sequences, as of a short item's hashes."""
    last = F.size(hashes) - n
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(hashes, i, n)))
    ).otherwise(F.array().cast("array<bigint>"))


def _sliding(values: Column, width: int, pick: Callable[[Column, Column], Column], reach: int = 1) -> Column:
    """``pick`` of each run of ``width`` values, of what is left of it at the end, by doubling the runs."""
    if reach == width:
        return values
    step = min(reach, width - reach)

    def doubled(runs: Column) -> Column:
        rest = F.slice(runs, F.lit(step + 1), F.greatest(F.size(runs) - step, F.lit(0)))
        return _sliding(F.zip_with(runs, rest, pick), width, pick, reach + step)

    return _let(values, doubled)


def _kept_places(grams: Column, width: int) -> Column:
    """Places of the grams that are the least of a run of ``width`` grams that holds them."""

    def places(least: Column) -> Column:
        # The greatest of the least hashes of all runs around a gram is its own hash, if it is kept.
        edge = F.array_repeat(F.lit(-(1 << 63)), width - 1)
        around = _sliding(F.concat(edge, least, edge), width, lambda a, b: F.greatest(a, b))
        every = F.sequence(F.lit(0), F.size(grams) - 1)
        return _let(around, lambda top: F.filter(every, lambda i: F.get(grams, i) == F.get(top, i)))

    runs = F.size(grams) - width + 1
    least = F.slice(_sliding(grams, width, lambda a, b: F.least(a, b)), F.lit(1), F.greatest(runs, F.lit(0)))
    return F.when(runs > 0, _let(least, places)).otherwise(F.array().cast("array<int>"))


def item_grams(items: DataFrame, id_col: str, text_col: str, span: int, gram: int) -> DataFrame:
    """Rows of (n_words of the window, gram hash, words around the gram, place of the gram in them, item)."""
    item = items.select(F.col(id_col).cast("string").alias("item"), words_of(text_col).alias("words"))
    reach = span - gram

    def kept(grams: Column) -> Column:
        return F.transform(
            _kept_places(grams, reach + 1), lambda i: F.struct(i.alias("at"), F.get(grams, i).alias("value"))
        )

    long_items = (
        item.where(F.size("words") >= span)
        .select("item", "words", _let(_grams_of(F.col("words"), gram), kept).alias("kept"))
        .select("item", "words", F.explode("kept").alias("k"))
        .withColumn("from", F.greatest(F.col("k.at") - reach, F.lit(0)))
        .select(
            F.lit(span).alias("window"),
            F.col("k.value").alias("value"),
            F.slice("words", F.col("from") + 1, F.col("k.at") - F.col("from") + gram + reach).alias("around"),
            (F.col("k.at") - F.col("from")).alias("place"),
            "item",
        )
    )
    short = item.where((F.size("words") > 0) & (F.size("words") < span)).select(
        F.size("words").alias("window"),
        F.xxhash64(_hashes(F.col("words"))).alias("value"),
        F.col("words").alias("around"),
        F.lit(0).alias("place"),
        "item",
    )
    return long_items.unionByName(short).distinct()


def _grams_of(words: Column, gram: int) -> Column:
    return _let(_hashes(words), lambda hashes: _grams(hashes, gram))


def _row_key(id_col: str, text_col: str) -> Column:
    """A number that is never null and spreads rows without an id; rows that share one are still judged by their words."""
    return F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(id_col))


def _document_grams(docs: DataFrame, id_col: str, text_col: str, span: int, gram: int, short: list[int]) -> DataFrame:
    """Rows of (key of the document, n_words of the window, place of the kept gram, its hash)."""

    def placed(grams: Column, places: Column, window: int) -> Column:
        return F.transform(
            places, lambda i: F.struct(F.lit(window).alias("window"), i.alias("at"), F.get(grams, i).alias("value"))
        )

    def whole(hashes: Column, n: int) -> Column:
        return F.transform(
            _short_grams(hashes, n), lambda g, i: F.struct(F.lit(n).alias("window"), i.alias("at"), g.alias("value"))
        )

    def kept(hashes: Column) -> Column:
        least = _let(_grams(hashes, gram), lambda grams: placed(grams, _kept_places(grams, span - gram + 1), span))
        return F.concat(least, *(whole(hashes, n) for n in short))

    found = docs.select(_row_key(id_col, text_col).alias("_key"), _let(_hashes(words_of(text_col)), kept).alias("kept"))
    # Not explode(), for which Spark would compute the array once more to see that it is not empty.
    rows = found.select("_key", F.explode_outer("kept").alias("k"))
    return rows.select("_key", "k.window", "k.at", "k.value")


def _matches(sides: Column, words: Column, span: int, gram: int) -> Column:
    """Item, window and starts of the document's windows that equal the item's, for each side that has any."""
    reach = span - gram

    def equal_starts(side: Column) -> Column:
        at = side["at"]
        near = F.filter(
            F.sequence(F.lit(0), F.lit(reach)),
            lambda d: (at >= d)
            & (side["place"] >= d)
            & (at - d + span <= F.size(words))
            & (side["place"] - d + span <= F.size(side["around"]))
            & (F.slice(words, at - d + 1, span) == F.slice(side["around"], side["place"] - d + 1, span)),
        )
        same = F.slice(words, at + 1, side["window"]) == side["around"]
        here = F.when(same, F.array(at)).otherwise(F.array().cast("array<int>"))
        return F.when(side["window"] == span, F.transform(near, lambda d: at - d)).otherwise(here)

    def match(side: Column) -> Column:
        return F.struct(side["item"].alias("item"), side["window"].alias("window"), equal_starts(side).alias("starts"))

    return F.filter(F.transform(sides, match), lambda m: F.size(m["starts"]) > 0)


def _hit_words(matches: Column) -> Column:
    spans = F.transform(
        matches, lambda m: F.flatten(F.transform(m["starts"], lambda s: F.sequence(s, s + m["window"] - 1)))
    )
    return F.array_distinct(F.flatten(spans))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``n_words``, places of the ``hit_words``, their number ``n_hit``, and the ``items`` found.

    ``items`` are ids as strings, sorted; ``keep_cols`` are handed through.
    """
    sides = item_grams(items, item_id_col, item_text_col, span, gram)
    n_item = F.size(words_of(item_text_col))
    short = items.agg(F.collect_set(F.when((n_item > 0) & (n_item < span), n_item)).alias("short")).first()["short"]
    size = sides.agg(F.sum(64 + 16 * F.size("around") + F.octet_length(F.array_join("around", ""))).alias("bytes")).first()
    small = (size["bytes"] or 0) <= broadcast_bytes
    wanted = _document_grams(docs, id_col, text_col, span, gram, sorted(short))
    hit = wanted.join(F.broadcast(sides) if small else sides, ["window", "value"])
    # All that is to be compared in a document, by its key.
    found = hit.groupBy("_key").agg(
        F.collect_set(F.struct("window", "at", "around", "place", "item")).alias("_sides")
    )
    keyed = docs.select(id_col, text_col, *keep_cols, _row_key(id_col, text_col).alias("_key"))
    joined = keyed.join(found, "_key", "left")

    def judged(words: Column) -> Column:
        matches = _matches(F.col("_sides"), words, span, gram)
        none = F.array().cast("array<struct<item:string,window:int,starts:array<int>>>")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.when(F.col("_sides").isNotNull(), matches).otherwise(none).alias("matches"),
        )

    def figures(seen: Column) -> Column:
        named = F.filter(F.transform(seen["matches"], lambda m: m["item"]), lambda item: item.isNotNull())
        return F.struct(
            seen["n_words"].alias("n_words"),
            _hit_words(seen["matches"]).alias("hit_words"),
            F.array_sort(F.array_distinct(named)).alias("items"),
        )

    found = _let(words_of(text_col), lambda words: _let(judged(words), figures))
    # The struct is made once: whatever reads its fields stands behind an array of one.
    rows = joined.select(id_col, *keep_cols, F.inline(F.array(found)))
    return rows.select("*", F.size("hit_words").cast("long").alias("n_hit"))
