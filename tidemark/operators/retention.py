"""Keep the newest rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEPT_RECORDS = 500


def keep_last(df: DataFrame, group: list[str], newest_first: list[Column], rows: int = KEPT_RECORDS) -> DataFrame:
    """The ``rows`` newest rows of each group.

    Every task passes on at most ``rows`` rows per group (``WindowGroupLimit``),
    so one exchange moves few rows however large a group is.
    """
    newest = Window.partitionBy(*group).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= rows).drop("_rank")
