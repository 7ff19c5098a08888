"""Newest record per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key: the first in ``newest_first`` order.

    Remaining ties fall to the largest values of the other columns, so that a
    rerun keeps the same row.  Spark limits each key to its first row before
    the shuffle (``WindowGroupLimit``): a key with a third of all rows sends
    one row per task.
    """
    ties = [F.desc(name) for name in df.columns if name not in keys]
    order = Window.partitionBy(*keys).orderBy(*newest_first, *ties)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def overlay(existing: DataFrame, batch: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """Keyed union: a batch row replaces the existing rows of its key.

    Among batch rows of one key the last in ``arrival`` order wins.  The
    ``arrival`` columns belong to the batch only and are not returned.  Existing
    rows have one row per key already; they are only compared with the batch's
    keys, so that they stay where they are while the batch is small.
    """
    columns = existing.columns
    newest = latest_by(batch, keys, [F.desc(name) for name in arrival])
    untouched = existing.join(newest.select(*keys), keys, "left_anti")
    return untouched.select(*columns).unionByName(newest.select(*columns))
