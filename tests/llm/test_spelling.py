"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.spelling import count_words, group_variants, near_words, roots, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_counts(docs, slips=199, min_length=6, min_count=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and h % slips == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if n >= min_count and len(word) >= min_length}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=5):
    out, forms = {}, {}
    for word, n in counts.items():
        near = [other for other in counts if one_edit(word, other)]
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None
        out[word] = (n, forms[word], counts.get(forms[word]), len(near))
    rows = []
    for word, (n, form, form_n, n_near) in out.items():
        root = word
        while forms[root]:
            root = forms[root]
        rows.append((word, n, form, form_n, root, n_near))
    return sorted(rows)


def got(df):
    return sorted(map(tuple, df.select("word", "n", "form", "form_n", "root", "n_near").collect()))


def vocabulary(r, n):
    words = set()
    while len(words) < n:
        word = "".join(r.choice("abÀÿ") for _ in range(r.randrange(2, 9)))
        words.add(word)
        for _ in range(r.randrange(4)):
            place, kind = r.randrange(len(word) + 1), r.randrange(3)
            word = word[:place] + ("" if kind == 0 else r.choice("abcé")) + word[place + (kind != 1) :]
            if len(word) > 1:
                words.add(word)
    return sorted(words)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("group", [0, 20, 10**9])
def test_near_words(spark, seed, group):
    words = vocabulary(random.Random(seed), 220)
    found = near_words(spark.createDataFrame([(w,) for w in words], "word string"), group).collect()
    pairs = sorted(map(tuple, found))
    assert pairs == sorted((a, b) for a in words for b in words if one_edit(a, b))


@pytest.mark.parametrize("seed", range(3))
def test_forms_and_roots(spark, seed):
    r = random.Random(seed)
    counts = {word: r.choice([5, 6, 25, 30, 125, 150, 700, 4000, 20_000]) for word in vocabulary(r, 150)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(group_variants(df)) == brute(counts)


def test_long_chain(spark):
    """Every form has five times its word's occurrences, twelve times over."""
    counts = {"a" * (6 + i): 5 ** (i + 1) for i in range(13)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = got(group_variants(df))
    assert rows == brute(counts)
    assert {row[4] for row in rows} == {"a" * 18}


def test_words_that_share_half(spark):
    """Thousands of words with a common half: the group is not joined pair by pair."""
    r = random.Random(4)
    words = sorted({"common" + "".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(3000)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    found = sorted(map(tuple, near_words(df, 500).collect()))
    known, expected = set(words), []
    for word in words:
        for place in range(6, 12):
            for letter in "abcdefgh":
                other = word[:place] + letter + word[place + 1 :]
                if other in known and other != word:
                    expected.append((word, other))
    assert found == sorted(expected)


def text_of(r, words):
    return "".join(r.choice(words) + r.choice([" ", "-", "3", "\n", "ā", "_"]) for _ in range(r.randrange(300)))


@pytest.mark.parametrize("slips", [0, 2, 7])
def test_counts(spark, slips):
    r = random.Random(slips)
    words = ["Letter", "LETTER", "lettÉr", "lettér", "ab", "straße", "Ÿabcdef", "×÷×÷×÷", "abcdefg", "abcdefgh", "x" * 5000]
    docs = [(i % 17 or None, text_of(r, words)) for i in range(40)] + [(1, None), (2, ""), (3, "letter " * 400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for flush in (1, 8 << 20):
        found = {row.word: row.n for row in count_words(df, slips=slips, flush_bytes=flush).collect()}
        assert found == brute_counts(docs, slips)


def test_whole_operator(spark):
    r = random.Random(8)
    words = vocabulary(r, 30)
    docs = [(i, text_of(r, words)) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("word", "n", "form", "key", "prefix"):
        df = df.withColumn(name, F.lit("x"))
    assert got(spelling_variants(df)) == brute(brute_counts(docs))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(docs).collect() == []
    nulls = spark.createDataFrame([(None, None), (1, None)], "doc_id long, text string")
    assert spelling_variants(nulls).collect() == []
    assert roots(spark.createDataFrame([], "word string, form string"), 0).collect() == []
