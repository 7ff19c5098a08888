"""Targets, flows and the mix of documents."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import capped_targets, min_cost_flow, mix, mix_documents, source_targets


def test_targets():
    sizes, weights = {"a": 10, "b": 1000, "c": 90}, {"a": 5, "b": 2, "c": 1}
    targets = capped_targets(sizes, weights, 1100)
    assert targets["a"] == 30 and targets["c"] == 270 and targets["b"] == pytest.approx(800)
    assert capped_targets({}, {}, 0) == {} and capped_targets({"a": 0}, {"a": 5}, 0) == {"a": 0}


def least_cost(patterns, quotas, repeats):
    """By trying all amounts."""
    arcs = [(p, s) for p, (_, sources) in patterns.items() for s in sources]
    best = None
    for amounts in itertools.product(*(range(quotas.get(s, 0) + 1) for _, s in arcs)):
        into, out = {}, {}
        for (p, s), amount in zip(arcs, amounts):
            out[p] = out.get(p, 0) + amount
            into[s] = into.get(s, 0) + amount
        if any(out[p] > repeats * patterns[p][0] for p in out) or any(into[s] > quotas.get(s, 0) for s in into):
            continue
        cost = sum(max(0, out[p] - k * patterns[p][0]) for p in out for k in range(1, repeats))
        key = (-sum(amounts), cost)
        best = key if best is None or key < best else best
    return best


@pytest.mark.parametrize("seed", range(25))
def test_flow_is_of_least_cost(seed):
    r = random.Random(seed)
    names = ["x", "y", None]
    patterns = {f"p{i}": (r.randint(0, 3), r.sample(names, r.randint(1, 2))) for i in range(3)}
    quotas = {s: r.randint(0, 4) for s in names}
    flow = min_cost_flow(patterns, quotas, 3)
    out, into = {}, {}
    for (p, s), amount in flow.items():
        assert amount > 0 and s in patterns[p][1]
        out[p], into[s] = out.get(p, 0) + amount, into.get(s, 0) + amount
    assert all(out[p] <= 3 * patterns[p][0] for p in out) and all(into[s] <= quotas[s] for s in into)
    cost = sum(max(0, out.get(p, 0) - k * patterns[p][0]) for p in patterns for k in (1, 2))
    assert (-sum(flow.values()), cost) == least_cost(patterns, quotas, 3)


def test_overlapping_sources(spark):
    rows = [(i, i % 7, [["a"], ["b"], ["a", "b"], ["b", "a"], [None]][i % 5]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>").repartition(4)
    quotas = {"a": 300, "b": 250, None: 50}
    got = mix(docs, quotas, seed=3).collect()
    assert len(got) == 200 and all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert sum(r.taken for r in got) == 600
    assert len({r.pattern for r in got}) == 4
    assert sorted(map(str, got)) == sorted(map(str, mix(docs.repartition(2), quotas, seed=3).collect()))


def test_documents(spark):
    rows = [(i, "w " * (i % 9), ["a", "b", "c", None][i % 4], 1) for i in range(100)] + [(7, None, "a", 1), (None, "x y", "b", 1), (3, "w w w", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    got = mix_documents(df).collect()
    assert len(got) == len(rows)
    by_target = {}
    for r in got:
        by_target.setdefault((r.target, r.source_size), []).append(r)
    for (target, _), group in by_target.items():
        # Sources of equal size and weight have equal targets.
        sources = sum(r["size"] for r in group) // group[0].source_size
        assert sum(r["size"] for r in group) == sources * group[0].source_size
        assert sum(r.taken for r in group) == sources * round(target) <= sources * 3 * group[0].source_size
    assert mix_documents(df.limit(0)).count() == 0
    assert {r.taken for r in mix_documents(df.withColumn("text", F.lit(""))).collect()} == {0}


@pytest.mark.parametrize("seed", range(3))
def test_targets_in_spark(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i:04}": r.choice([0, 1, 10, 1000, 10**6]) * r.randint(0, 9) for i in range(40)} | {None: r.randint(0, 99)}
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {source: (5, 2, 1)[i % 3] for i, source in enumerate(order)}
    given = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(given).collect()}
    expected = capped_targets(sizes, weights, sum(sizes.values()))
    assert got.keys() == expected.keys()
    assert all(got[s] == pytest.approx(expected[s]) for s in got)


def test_components_flow_apart(spark):
    # Chains a-b and c-d, and sources of their own; quotas as a table, one source without a quota.
    kinds = [["a"], ["a", "b"], ["c", "d"], ["d"], ["own"], ["none"], [], None]
    rows = [(i, 1 + i % 5, kinds[i % len(kinds)]) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")
    quotas = {"a": 70, "b": 90, "c": 100, "d": 20, "own": 30}
    patterns = {}
    for _, size, sources in rows:
        name = "[" + ",".join(f'"{s}"' for s in sources or []) + "]"
        patterns[name] = (patterns.get(name, (0,))[0] + size, sources or [])
    flow = {}
    for (name, _), amount in min_cost_flow(patterns, quotas | {"none": 0}, 3).items():
        flow[name] = flow.get(name, 0) + amount
    taken = {}
    for r in mix(docs, spark.createDataFrame(list(quotas.items()), "source string, quota long"), seed=1).collect():
        taken[r.pattern] = taken.get(r.pattern, 0) + r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    assert sum(taken.values()) == sum(flow.values()) == 310
    assert {name: n for name, n in taken.items() if n}.keys() == flow.keys()


def test_ids_that_most_rows_share(spark):
    """A third of the ids null, a third the same: no task holds them, and the words taken are those of one line."""
    n = 6000
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, "w " * (i % 4), "s" if i % 5 else "t") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mix_documents(df).collect()
    assert len(got) == n and all(0 <= r.taken <= 3 * r["size"] for r in got)
    again = mix_documents(df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    for size in {r.source_size for r in got}:
        group = [r for r in got if r.source_size == size]
        assert sum(r.taken for r in group) == round(group[0].target)


def test_more_sources_than_the_driver_should_hold(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 7 as int)) AS text", "concat('h', id) AS source")
    got = mix_documents(df).collect()
    assert len(got) == 3000 and all(abs(r.taken - r.target) <= 0.5 for r in got)
