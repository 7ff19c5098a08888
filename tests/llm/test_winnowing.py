"""Decontamination against a brute-force version."""

import random
import re
import time

import pytest

from tidemark.llm.winnowing import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, span=10):
    out = []
    for doc_id, text in docs:
        own = words(text)
        hit, found = set(), set()
        for item_id, item in items:
            item_words = words(item)
            n = min(span, len(item_words))
            windows = {tuple(item_words[i : i + n]) for i in range(len(item_words) - n + 1)} if n else set()
            for i in range(len(own) - n + 1 if n else 0):
                if tuple(own[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(item_id)
        out.append((doc_id, len(own), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=str)


def case(seed):
    r = random.Random(seed)
    vocabulary = ["a", "B", "c", "dd", "É", "é", "x1"][: r.choice([2, 4, 7])]
    text = lambda n: r.choice([" ", ", "]).join(r.choice(vocabulary) for _ in range(n))
    items = [(i % 9, text(r.choice([0, 1, 3, 9, 10, 11, 14, 30]))) for i in range(12)] + [(10, None), (11, " .,")]
    docs = [(i, text(r.choice([0, 2, 9, 10, 25, 60])) + r.choice(["", " . ", items[i % 12][1]]) + text(5)) for i in range(25)]
    return docs + [(25, None), (25, ""), docs[3], (3, text(40)), (26, "a " * 400)], items


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_against_brute_force(spark, seed, limit):
    docs, items = case(seed)
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(decontaminate(left, right, broadcast_bytes=limit)) == brute(docs, items)


def test_empty_sides(spark):
    docs, items = case(9)
    none = spark.createDataFrame([], "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate(none, right).count() == 0
    left = spark.createDataFrame(docs, "doc_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate(left, empty).collect()} == {0}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_null_ids_are_judged(spark, limit):
    """Documents without an id are judged by their own texts, as brute force does it."""
    docs, items = case(5)
    item = next(text for _, text in items if len(words(text)) > 10)
    docs += [(None, f"before {item} after"), (None, f"else {item}"), (None, f"else {item}"), (None, "clean " * 20), (None, None)]
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(decontaminate(left, right, broadcast_bytes=limit))
    assert got == brute(docs, items)
    assert sorted(hit > 0 for doc_id, _, hit, _ in got if doc_id is None) == [False, False, True, True, True]


def test_long_document_equal_to_an_item(spark):
    """The work grows with the words: 64,000 of them, all in one item."""
    r = random.Random(3)
    long = " ".join(f"w{r.randrange(30_000)}" for _ in range(64_000))
    docs = [(1, long), (2, "tick tock " * 20_000), (3, "else " + long[:5_000]), (4, "clean " * 50)]
    items = [("a", long), ("b", "tick tock " * 30)]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id string, text string")
    start = time.monotonic()
    got = {doc_id: (n, hit, found) for doc_id, n, hit, found in rows_of(decontaminate(left, right))}
    assert time.monotonic() - start < 40
    assert got[1] == (64_000, 64_000, ["a"]) and got[2] == (40_000, 40_000, ["b"]) and got[4] == (50, 0, [])
    assert got[3][2] == ["a"] and got[3][0] - got[3][1] in (1, 2)
