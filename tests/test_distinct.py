"""Mergeable distinct counts against sets."""

import random
from collections import defaultdict

import pytest
from pyspark.errors import PySparkException

from tidemark.operators import distinct
from tidemark.session import materialise

SCHEMA = "day int, kind string, sale string, number int"


def rows(seed, n):
    r = random.Random(seed)
    # A third of the rows is one value, days and kinds and values may be null.
    return [
        (r.choice([None, *range(6)]), r.choice(["a", "b", None]), r.choice(["hot", None, f"s{r.randrange(60)}"]), i)
        for i in range(n)
    ]


def sets(data, key):
    out = defaultdict(set)
    for row in data:
        out[key(row)] |= {row[2]} - {None}
    return {k: len(v) for k, v in out.items()}


@pytest.mark.parametrize("seed", range(3))
def test_batches_and_coarser_keys(spark, seed):
    batches = [rows(seed, 300), rows(seed + 10, 200), rows(seed, 50)]
    numbers, parts = None, []
    for batch in batches:
        df = spark.createDataFrame(batch, SCHEMA)
        numbers = distinct.numbered(df, "sale", ["day", "kind"], numbers)
        parts.append(distinct.states(df, "sale", ["day", "kind"], numbers))
    data = sum(batches, [])
    assert numbers.count() == numbers.select("sale").distinct().count() == len({r[2] for r in data} - {None})
    states = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = {(r.day, r.kind): r.n for r in distinct.counted(states, ["day", "kind"], "n").collect()}
    assert got == sets(data, lambda r: r[:2])
    by_kind = distinct.counted(distinct.merged(states, ["day", "kind"]), ["kind"], "n")
    assert {r.kind: r.n for r in by_kind.collect()} == sets(data, lambda r: r[1])


def test_more_values_than_a_bitmap_holds(spark):
    df = spark.range(100_000).selectExpr("id % 3 AS day", "CAST(id AS STRING) AS sale")
    numbers = distinct.numbered(df, "sale", ["day"])
    states = distinct.states(df, "sale", ["day"], numbers)
    got = {r.day: r.n for r in distinct.counted(states, ["day"], "n").collect()}
    assert got == {0: 33_334, 1: 33_333, 2: 33_333}
    # Values first seen on one day lie together: few bitmaps a day.
    assert states.count() <= 3 * (100_000 // 32_768 + 1 + numbers.rdd.getNumPartitions())


def test_nulls_empty_and_unnumbered(spark):
    df = spark.createDataFrame([(1, "a", None, 0), (1, "a", None, 1)], SCHEMA)
    numbers = distinct.numbered(df, "sale", ["day"])
    counts = distinct.counted(distinct.states(df, "sale", ["day"], numbers), ["day"], "n")
    assert [(r.day, r.n) for r in counts.collect()] == [(1, 0)]
    none = df.limit(0)
    assert distinct.counted(distinct.states(none, "sale", ["day"], numbers), ["day"], "n").count() == 0
    late = spark.createDataFrame([(1, "a", "new", 0)], SCHEMA)
    with pytest.raises(PySparkException, match="without a number"):
        distinct.states(late, "sale", ["day"], numbers).collect()


def test_written_states_do_not_read_the_rows(spark):
    df = materialise(spark.createDataFrame(rows(1, 100), SCHEMA), "sales_rows")
    written = materialise(distinct.states(df, "sale", ["day"], distinct.numbered(df, "sale", ["day"])), "sale_states")
    plan = distinct.counted(written, [], "n")._jdf.queryExecution().toString()
    assert "sale_states" in plan and "sales_rows" not in plan
