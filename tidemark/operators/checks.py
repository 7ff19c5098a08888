"""Declarative data tests.  Each returns its offending rows; none means passed."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL aside: ``value, n_records``."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, NULL aside: ``value, n_records``."""
    return (
        df.where(~F.col(column).isin(values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, NULL aside: ``value, n_records``.

    Both sides are reduced to distinct values first, combined before the
    shuffle; the join then finds them partitioned by value already.  An anti
    join would be moved below the child's aggregation, where it meets every
    row, so this is an outer join that keeps the unmatched.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias("value")).distinct().withColumn("_known", F.lit(True))
    return values.join(known, "value", "left").where(F.col("_known").isNull()).drop("_known")


@dataclass(frozen=True)
class Tests:
    """Tests of one relation."""

    __test__ = False

    relation: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, list[str]] = field(default_factory=dict)
    # column -> (parent relation, parent column)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    # name -> (column named in the report, condition that marks a bad row)
    rules: dict[str, tuple[str, Column]] = field(default_factory=dict)


def report(relations: dict[str, DataFrame], suite: list[Tests]) -> DataFrame:
    """One row per test: ``test, relation, column_name, failures, status``.

    Failures count duplicated values (unique), rows (not_null, rules,
    relationships) or distinct values (accepted_values).  A relation is read
    twice at most: once grouped by its first unique column, with the row-wise
    counts carried along as sums, and once grouped by the values that are
    compared with a list or a parent, of which there are few.
    """
    parts = [part for tests in suite for part in _parts(relations, tests)]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")
    )


def _parts(relations: dict[str, DataFrame], tests: Tests):
    df = relations[tests.relation]
    rows: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in tests.not_null]
    rows += [(name, column, bad) for name, (column, bad) in tests.rules.items()]
    counts = [F.count_if(bad).alias(f"f{i}") for i, (_, _, bad) in enumerate(rows)]
    lines = [(test, column, F.col(f"f{i}")) for i, (test, column, _) in enumerate(rows)]
    if tests.unique:
        key = tests.unique[0]
        grouped = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), *counts)
        sums = [F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(rows))]
        repeated = F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)).alias("repeated")
        yield _lines(grouped.agg(repeated, *sums), tests.relation, [("unique", key, F.col("repeated")), *lines])
    elif rows:
        yield _lines(df.agg(*counts), tests.relation, lines)
    for column in tests.unique[1:]:
        found = unique(df, column).agg(F.count(F.lit(1)).alias("n"))
        yield _lines(found, tests.relation, [("unique", column, F.col("n"))])
    if not tests.accepted and not tests.parents:
        return
    outside = {c: F.when(~F.col(c).isin(values), F.col(c)) for c, values in tests.accepted.items()}
    values = df.groupBy(
        *(expression.alias(f"outside_{c}") for c, expression in outside.items()),
        *(F.col(c).alias(f"child_{c}") for c in tests.parents),
    ).agg(F.count(F.lit(1)).alias("n_records"))
    if outside:
        distinct = values.agg(*(F.count_distinct(f"outside_{c}").alias(c) for c in outside))
        yield _lines(distinct, tests.relation, [("accepted_values", c, F.col(c)) for c in outside])
    for column, (parent, parent_column) in tests.parents.items():
        known = relations[parent].select(F.col(parent_column).alias("value")).distinct()
        child = values.select(F.col(f"child_{column}").alias("value"), "n_records").where("value IS NOT NULL")
        orphans = child.join(known.withColumn("_known", F.lit(True)), "value", "left").where("_known IS NULL")
        total = orphans.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("n"))
        yield _lines(total, tests.relation, [("relationships", column, F.col("n"))])


def _lines(row: DataFrame, relation: str, figures: list[tuple[str, str, Column]]) -> DataFrame:
    """The figures of a one-row table, a line each."""
    return row.select(F.inline(F.array(*(_line(test, relation, column, n) for test, column, n in figures))))


def _line(test: str, relation: str, column: str, failures: Column) -> Column:
    return F.struct(
        F.lit(test).alias("test"),
        F.lit(relation).alias("relation"),
        F.lit(column).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    )
