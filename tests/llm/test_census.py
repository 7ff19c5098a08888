"""Equal rows are one row at home, and messages grow with the tags."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import census
from tidemark.llm.ngram_join import near_duplicates
from tidemark.llm.relative_lz import remove_passages
from tidemark.llm.suffix_dedup import remove_strings


@pytest.fixture(scope="module")
def equal_rows(spark):
    """A third of the rows equal with an id, a third equal without one, the rest of their own."""
    r = random.Random(1)
    words = lambda k: " ".join(f"w{r.randrange(500)}" for _ in range(k))
    shared = words(70)
    rows = []
    for i in range(400):
        rows += [(7, shared + " one"), (None, shared + " two"), (1000 + i, f"{words(20)} {shared if i % 100 == 0 else ''}")]
    return rows, spark.createDataFrame([(*row, "en") for row in rows], "doc_id long, text string, lang string").repartition(5)


def counted(rows):
    found = {}
    for row in rows:
        found[row] = found.get(row, 0) + 1
    return found


def test_equal_rows_are_one_at_home(equal_rows):
    rows, df = equal_rows
    homes = census.at_home(df, "doc_id", "text", ("lang",), 8)
    assert homes.columns == ["_home", "_id", "_text", "_bytes", "_copies", "lang"]
    sizes = homes.groupBy("_home").agg(F.count("*").alias("n"), F.sum("_copies").alias("c")).collect()
    assert sum(r.n for r in sizes) == 402 and sum(r.c for r in sizes) == 1200
    assert max(r.n for r in sizes) < 100
    # Rows that differ in a kept column only stay apart.
    other = census.at_home(df.withColumn("lang", F.when(F.rand(1) < 0.5, "de")), "doc_id", "text", ("lang",), 8)
    assert other.where("_copies > 1").count() == 4
    # The texts are shuffled once.
    assert homes._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(_home") == 1


@pytest.mark.parametrize("remove", [remove_passages, remove_strings])
def test_every_equal_row_comes_back(equal_rows, remove, monkeypatch):
    monkeypatch.setattr(census, "COPIES", 60)
    rows, df = equal_rows
    got = [(r.doc_id, r.n_removed > 0, r.lang) for r in remove(df, keep_cols=("lang",), home_bytes=9_000).collect()]
    # The passage starts in document 7; its own rows keep it.
    expected = counted((i, i != 7 and len(text.split()) > 50, "en") for i, text in rows)
    assert counted(got) == expected


def test_equal_rows_of_the_join(equal_rows):
    rows, df = equal_rows
    got = near_duplicates(df, home_bytes=9_000)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    ids = counted((r.doc_id, r.component_id) for r in got.collect())
    assert ids[7, 7] == ids[None, 7] == 400 and sum(ids.values()) == 1200


def test_copies_are_given_back_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(census, "COPIES", 10)
    numbers = [1, 2, 9, 10, 11, 20, 25]
    rows = spark.createDataFrame([(n, n) for n in numbers], "n long, _copies long")
    assert counted(r.n for r in census.repeated(rows).collect()) == {n: n for n in numbers}


def test_messages_grow_with_tags():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 28_000, dtype=np.uint64))
    per_tag = {}
    for homes in (10, 100, 1_000, 10_000):
        buckets = census.buckets_for(homes, 4 << 20, 150)
        sent = census.tags(0, keys, np.ones(len(keys), np.int64), buckets).num_rows
        per_tag[homes] = sent / len(keys)
    # Every home sends as many messages per tag from 64 to several thousand homes, not more with each home.
    assert per_tag[100] == per_tag[1_000] == per_tag[10_000] < 1 / 400
    assert census.buckets_for(100_000, 4 << 20, 150) < 100_000 / 100
