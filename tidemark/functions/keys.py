"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def holiday_key(day_text: Column, name: Column, kind: Column) -> Column:
    """SHA-256 hex of ``date_name_type`` in lower case."""
    return F.sha2(F.concat_ws("_", day_text, F.lower(name), F.lower(kind)), 256)
