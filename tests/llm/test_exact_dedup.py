"""Exact dedup against a brute-force version, and what the summaries promise."""

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import Summary, frequent, mark_duplicates, survivors


def normal(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        rows = [(i, best, len(ids), False, digest) for i in ids]
        place = ids.index(best)
        rows[place] = (*rows[place][:3], True, digest)
        out += rows
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def case(seed):
    r = random.Random(seed)
    texts = ["", None, "a", "A", "É", "é", "Ab\nc", "aB\nC", "İ", "x" * 100_000, " "]
    docs = [(r.choice([None, *range(40)]), r.choice(texts + [f"t{r.randrange(60)}"] * 9)) for _ in range(200)]
    docs += [(i, "Hot Text") for i in range(300)] + [(7, "same")] * 50 + [(None, "no id")] * 20
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("counters", [1, 5, 4096])
def test_against_brute_force(spark, seed, counters):
    docs = case(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(mark_duplicates(df, counters=counters)) == brute(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert mark_duplicates(df).collect() == []
    assert survivors(df).collect() == []


def test_clashing_names(spark):
    docs = case(5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("keep_id", "_digest", "_row", "_id", "kept", "_place", "_size"):
        df = df.withColumn(name, F.lit(-1))
    assert got(mark_duplicates(df)) == brute(docs)
    kept = survivors(df)
    assert kept.columns == df.columns
    expected = Counter((i, digest) for i, _, _, kept, digest in brute(docs) if kept)
    found = Counter((row.doc_id, hashlib.sha256(normal(row.text).encode()).hexdigest()) for row in kept.collect())
    assert found == expected


def test_other_id_types(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "X"), (None, "x")], "name string, body string")
    rows = mark_duplicates(df, "name", "body").collect()
    assert {(row.name, row.keep_id, row.kept) for row in rows} == {("b", "b", True), ("a", "b", False), (None, "b", False)}


@pytest.mark.parametrize("counters", [1, 3, 10])
def test_summary_bound(counters):
    r = random.Random(counters)
    values = [b"%d" % min(r.randrange(1, 30), r.randrange(1, 30)) for _ in range(3000)]
    summary = Summary(counters)
    for start in range(0, len(values), 70):
        summary.add(pa.array(values[start : start + 70], pa.binary()))
    assert len(summary.counts) <= counters
    for value, n in Counter(values).items():
        assert n - len(values) / (counters + 1) <= summary.counts.get(value, 0) <= n


def test_frequent_values_are_few_and_complete(spark):
    r = random.Random(1)
    values = [b"hot"] * 2000 + [b"warm"] * 900 + [b"%d" % r.randrange(10**6) for _ in range(3000)]
    r.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v binary").repartition(7)
    for counters in (4, 20):
        found = {bytes(row.v) for row in frequent(df, "v", counters).collect()}
        assert len(found) <= counters + 1
        assert {v for v, n in Counter(values).items() if n >= 2 * len(values) / (counters + 1)} <= found


def test_hot_group_is_not_shuffled(spark):
    """The rows of a text that half of all documents share never meet in one task."""
    docs = [(i, "hot" if i % 2 else f"text {i}") for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    marked = mark_duplicates(df, counters=64)
    assert marked.where("kept").count() == 2001
    per_task = marked.where("group_size > 1").groupBy(F.spark_partition_id()).count().collect()
    assert max(row["count"] for row in per_task) <= 1200
