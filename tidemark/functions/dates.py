"""Date parsing and calendar labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.rounding import rounded


def instant(moment: dt.datetime | Column) -> Column:
    """A timestamp column; a datetime without a zone is UTC, not the machine's local time."""
    if isinstance(moment, dt.datetime):
        moment = F.lit(moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc))
    return moment.cast("timestamp")


def iso_date(text: Column, lenient: bool = False) -> Column:
    """The date that ``text`` spells as ``YYYY-MM-DD``, else NULL.

    ``lenient`` also takes the other ISO 8601 calendar and week forms:
    ``YYYYMMDD``, ``YYYY-Www``, ``YYYY-Www-D``, ``YYYYWww`` and ``YYYYWwwD``.
    """
    parsed = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), _calendar_date(text))
    if lenient:
        parsed = parsed.when(
            text.rlike(r"^[0-9]{8}\z"),
            _calendar_date(
                F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
            ),
        ).when(
            text.rlike(r"^[0-9]{4}(-W[0-9]{2}(-[0-9])?|W[0-9]{2}[0-9]?)\z"),
            _week_date(F.replace(text, F.lit("-"))),
        )
    return parsed


def _calendar_date(text: Column) -> Column:
    # Years start at 1: a year 0000 is no date in the contract.
    return F.when(~text.startswith("0000"), text.try_cast("date"))


def _week_date(compact: Column) -> Column:
    """Date of a compact ``YYYYWww[D]``; NULL where the year has no such week or day."""
    year = F.substring(compact, 1, 4).try_cast("int")
    week = F.substring(compact, 6, 2).try_cast("int")
    day = F.coalesce(F.substring(compact, 8, 1).try_cast("int"), F.lit(1))
    # 4 January always lies in week 1, 28 December in the last week.
    fourth = F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))
    last_week = F.weekofyear(F.make_date(F.greatest(year, F.lit(1)), F.lit(12), F.lit(28)))
    monday = F.date_sub(fourth, F.weekday(fourth))
    return F.when(
        (year >= 1) & week.between(1, last_week) & day.between(1, 7),
        F.date_add(monday, (week - 1) * 7 + day - 1),
    )


def month_start(instant: Column) -> Column:
    return F.trunc(instant.cast("date"), "month")


def month_label(day: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(day, "yyyy-MM")


def run_label(instant: Column) -> Column:
    """Run id such as ``20260105_134500``."""
    return F.date_format(instant, "yyyyMMdd_HHmmss")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with two decimals."""
    return rounded((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6), 2)


def is_weekend(day: Column) -> Column:
    """Days of the week count from Sunday = 1 to Saturday = 7."""
    return F.dayofweek(day).isin(1, 7)
