import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.budget import Budget
from tidemark.operators import checks
from tidemark.operators.latest import latest_by, overlay
from tidemark.operators.lookup import lookup_join
from tidemark.operators.nearest import nearest_dates
from tidemark.operators.retention import keep_last
from tidemark.plans.calendar import date_spine
from tidemark.session import materialise, setting

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def multiset(df):
    return sorted(map(repr, (tuple(row) for row in df.collect())))


# --- lookup join ----------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_by_the_bytes_of_the_lookup(spark, how):
    # One key holds a third of the facts, in two partitions; some rows are exact copies; some keys are missing or NULL.
    facts = spark.range(0, 300, 1, 2).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") % 11).alias("k"),
        (F.col("id") % 50).alias("v"),
    )
    rows = [(k, f"n{i}") for k in (1, 3, 7) for i in range(k)]
    lookup = materialise(spark.createDataFrame(rows, "k long, name string"), "lookup")
    small = lookup_join(facts, lookup, ["k"], how)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    expected = multiset(small)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        large = lookup_join(facts, lookup, ["k"], how)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().toString()
        assert multiset(large) == expected


# --- nearest dates --------------------------------------------------------------

DAYS = st.dates(dt.date(2023, 12, 1), dt.date(2024, 3, 31))


@FEW
@given(marks=st.lists(st.one_of(DAYS, st.none()), max_size=12))
def test_nearest_dates_equal_the_definition(spark, marks):
    first, last = dt.date(2024, 1, 1), dt.date(2024, 2, 10)
    table = spark.createDataFrame([(m,) for m in marks], "day date")
    found = nearest_dates(date_spine(spark, first, last), table).collect()
    known = [m for m in marks if m]
    assert len(found) == (last - first).days + 1
    for day, ahead, behind in found:
        assert ahead == min((m for m in known if m >= day), default=None)
        assert behind == max((m for m in known if m <= day), default=None)


# --- newest per key -------------------------------------------------------------


def test_latest_takes_the_newest_and_breaks_ties_the_same_way(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "n"), ("b", 1, "m"), ("c", None, "q")]
    df = spark.createDataFrame(rows, "id string, ts int, v string")
    expected = [("a", 3, "z"), ("b", 1, "m"), ("c", None, "q")]
    for shuffled in (df, df.orderBy("v"), df.repartition(3)):
        kept = latest_by(shuffled, ["id"], [F.desc("ts")])
        assert sorted(tuple(r) for r in kept.collect()) == expected


def test_latest_ranks_before_the_shuffle(spark):
    plan = latest_by(spark.range(9).withColumn("v", F.col("id") % 3), ["v"], [F.desc("id")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text and "WindowGroupLimit" in text


def test_overlay_prefers_the_batch_and_its_last_arrival(spark):
    existing = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, v string")
    batch = spark.createDataFrame(
        [("a", "first", 0), ("a", "last", 1), ("c", "new", 0)], "id string, v string, seq int"
    )
    merged = overlay(existing, batch, ["id"], ["seq"])
    assert sorted(tuple(r) for r in merged.collect()) == [("a", "last"), ("b", "old"), ("c", "new")]


@FEW
@given(
    existing=st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 3), max_size=5),
    batch=st.lists(st.tuples(st.sampled_from("abcdefgh"), st.integers(0, 9)), max_size=12),
)
def test_overlay_equals_a_dictionary_update(spark, existing, batch):
    old = spark.createDataFrame(list(existing.items()), "id string, v int")
    new = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "id string, v int, seq int")
    merged = overlay(old, new, ["id"], ["seq"]).collect()
    assert sorted(tuple(r) for r in merged) == sorted({**existing, **dict(batch)}.items())


def test_keep_last_is_exact_for_a_hot_group(spark):
    df = spark.range(0, 1000, 1, 9).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), "id"
    )
    kept = keep_last(df, ["g"], [F.desc("id")], rows=5).collect()
    groups = {}
    for row in df.collect():
        groups.setdefault(row["g"], []).append(row["id"])
    expected = {(g, i) for g, ids in groups.items() for i in sorted(ids)[-5:]}
    assert {(r["g"], r["id"]) for r in kept} == expected and len(kept) == len(expected)


# --- data tests -----------------------------------------------------------------


def test_checks_ignore_nulls_where_the_rule_says_so(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    parent = spark.createDataFrame([("b",), ("b",), (None,)], "k string")
    assert [tuple(r) for r in checks.unique(df, "v").collect()] == [("a", 2)]
    assert checks.not_null(df, "v").count() == 2
    assert [tuple(r) for r in checks.accepted_values(df, "v", ["b"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in checks.relationships(df, "v", parent, "k").collect()] == [("a", 2)]


def test_report_counts_failures(spark):
    df = spark.createDataFrame([("a", -1), ("a", 5), (None, 2)], "v string, n int")
    suite = [
        checks.Tests(
            "t",
            unique=("v",),
            not_null=("v", "n"),
            accepted={"v": ["b"]},
            parents={"v": ("t", "v")},
            rules={"positive": ("n", F.col("n") < 0)},
        )
    ]
    found = {(r["test"], r["column_name"]): (r["failures"], r["status"]) for r in checks.report({"t": df}, suite).collect()}
    assert found == {
        ("unique", "v"): (1, "fail"),
        ("not_null", "v"): (1, "fail"),
        ("not_null", "n"): (0, "pass"),
        ("accepted_values", "v"): (1, "fail"),
        ("relationships", "v"): (0, "pass"),
        ("positive", "n"): (1, "fail"),
    }
