"""Joins of a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``facts`` with a written ``lookup`` on equal columns; ``how`` keeps the facts' side.

    The lookup should be a written table, of which Spark knows the bytes: below
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and the facts stay where
    they are.  Otherwise both sides are shuffled, and adaptive execution splits
    the facts of a hot key over many tasks.
    """
    return facts.join(lookup, on, how)
