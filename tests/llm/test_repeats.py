"""Repeated passages and byte strings against brute-force versions."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import hashing, suffix_dedup
from tidemark.llm.relative_lz import remove_passages
from tidemark.llm.suffix_dedup import remove_strings


def covered(rows, window):
    """For each row (id, units): the units inside a window that starts in a row with a smaller id."""
    least = {}
    rank = [(10**18 if i is None else i) for i, _ in rows]
    for r, (_, units) in zip(rank, rows):
        for at in range(len(units) - window + 1):
            key = tuple(units[at : at + window])
            least[key] = min(least.get(key, r), r)
    out = []
    for r, (_, units) in zip(rank, rows):
        hit = [False] * len(units)
        for at in range(len(units) - window + 1):
            if least[tuple(units[at : at + window])] < r:
                hit[at : at + window] = [True] * window
        out.append(hit)
    return out


def brute_words(rows, window):
    split = [(i, (text or "").encode().split()) for i, text in rows]
    out = []
    for (i, words), hit in zip(split, covered(split, window)):
        kept = b" ".join(w for w, h in zip(words, hit) if not h)
        out.append((i, len(words), sum(hit), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, window):
    split = [(i, (text or "").encode()) for i, text in rows]
    out = []
    for (i, data), hit in zip(split, covered(split, window)):
        kept = bytes(b for b, h in zip(data, hit) if not h)
        spans = sum(h and not (at and hit[at - 1]) for at, h in enumerate(hit))
        out.append((i, len(data), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def case(seed, n=40):
    r = random.Random(seed)
    vocabulary = ["a", "bé", "ccc", "d.", "EEEE", "f g"] + [f"w{i}" for i in range(r.choice([0, 30, 300]))]
    words = lambda k: [r.choice(vocabulary) for _ in range(k)]
    passages = [words(r.choice([5, 10, 17, 40, 90])) for _ in range(5)]
    rows = []
    for _ in range(n):
        own = words(r.choice([0, 3, 30])) + r.choice(passages) + words(r.choice([0, 1, 12]))
        if r.random() < 0.5:
            own += r.choice(passages)[r.choice([0, 1, 4]) :]
        if r.random() < 0.3:
            own = own * r.choice([2, 3])
        rows.append(r.choice([" ", "\n", "  "]).join(own))
    rows[5] = rows[6] = rows[30]
    rows[7] = "a " * 500
    rows[8] = "a " * 300
    ids = r.sample(range(1000), n)
    out = list(zip(ids, rows))
    return out + [(2000, None), (2001, ""), (None, rows[3]), (None, rows[5]), out[4], (ids[9], rows[10]), (2002, "é" * 400)]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "kept") for row in rows], "doc_id long, text string, _text string").repartition(3)


SIZES = [{}, {"home_bytes": 900, "block_bytes": 300}, {"home_bytes": 2000, "block_bytes": 700, "hot_pieces": 3}]


@pytest.mark.parametrize("sizes", SIZES)
@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed, sizes):
    rows = case(seed)
    got = remove_passages(frame(spark, rows).drop("_text"), window=12, gram=4, **sizes)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == brute_words(rows, 12)


@pytest.mark.parametrize("sizes", SIZES)
@pytest.mark.parametrize("seed", [3, 4])
def test_strings(spark, seed, sizes):
    rows = case(seed)
    got = remove_strings(frame(spark, rows).drop("_text"), window=20, gram=7, **sizes)
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()), key=str)
    assert found == brute_bytes(rows, 20)


def test_production_parameters(spark):
    rows = case(5)
    df = frame(spark, rows).drop("_text")
    got = remove_passages(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute_words(rows, 50)
    got = remove_strings(df).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str)
    assert found == brute_bytes(rows, 50)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert remove_passages(none).count() == 0
    assert remove_strings(none).count() == 0


def test_columns_are_in_order_with_their_common_prefixes():
    r = random.Random(7)
    for _ in range(30):
        pieces = [bytes(r.choice(b"ab\xff") for _ in range(r.randint(1, 9))) for _ in range(r.choice([1, 5, 30]))]
        anchors = np.array([r.randrange(len(p)) for p in pieces])
        lengths = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        first, end = -anchors, lengths - anchors
        columns = suffix_dedup.Columns(data, np.cumsum(lengths) - lengths + anchors, first, end, 4)
        for column in range(end.max() - 1, first.min() - 1, -1):
            columns.step(column)
            there = [i for i in range(len(pieces)) if first[i] <= column < end[i]]
            suffix = {i: pieces[i][column - first[i] :] for i in there}
            assert sorted(columns.order.tolist()) == there
            ordered = [suffix[i] for i in columns.order.tolist()]
            assert ordered == sorted(ordered)
            shared = [next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y))) for x, y in zip(ordered, ordered[1:])]
            assert columns.common.tolist()[1:] == [min(4, k) for k in shared]


def test_hashes():
    r = random.Random(8)
    values = np.array([r.getrandbits(64) for _ in range(200)], np.uint64)
    for n in (1, 2, 3, 5, 7, 12, 16, 31):
        found = hashing.grams(values, n)
        assert len(found) == 200 - n + 1 and len(set(found.tolist())) == len(found)
        again = hashing.grams(np.concatenate([values[50:], values[:50]]), n)
        assert (again[: 150 - n + 1] == found[50:]).all()
        assert (hashing.sliding_min(values, n) == [min(values[i : i + n]) for i in range(200 - n + 1)]).all()
    at = np.arange(0, 100)
    one = hashing.stretches(values, at, at + 20)
    assert (hashing.stretches(values[30:], at[:50], at[:50] + 20) == one[30:80]).all()
    assert hashing.words(np.frombuffer(b" ab\n\xc3\xa9 c", np.uint8))[0].tolist() == [1, 4, 7]
    assert not len(hashing.words(np.frombuffer(b"", np.uint8))[0])
