"""As-of search on the calendar: the nearest marked dates around each day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_dates(days: DataFrame, marks: DataFrame) -> DataFrame:
    """Next and previous marked date for each day, the day itself included.

    ``days`` and ``marks`` have one date column each.  Result: ``calendar_date,
    next_date, prev_date``; NULL where no mark lies ahead or behind.

    Both inputs first collapse to one row per date (combined before the
    shuffle, so a date with countless marks costs nothing extra).  One running
    minimum and maximum over the dates then replace the days x marks
    comparison.  That window runs over the whole calendar in one task: it holds
    one row per distinct date, some thousands, never one per mark.
    """
    (day,), (mark,) = days.columns, marks.columns
    spots = days.select(
        F.col(day).alias("calendar_date"), F.lit(None).cast("date").alias("mark"), F.lit(True).alias("asked")
    ).unionByName(
        marks.where(F.col(mark).isNotNull()).select(
            F.col(mark).alias("calendar_date"), F.col(mark).alias("mark"), F.lit(False).alias("asked")
        )
    )
    dates = spots.groupBy("calendar_date").agg(
        F.max("mark").alias("mark"), F.max("asked").alias("asked")
    )
    backward = Window.orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, 0)
    forward = Window.orderBy(F.desc("calendar_date")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        dates.withColumn("next_date", F.min("mark").over(forward))
        .withColumn("prev_date", F.max("mark").over(backward))
        .where("asked")
        .select("calendar_date", "next_date", "prev_date")
    )
