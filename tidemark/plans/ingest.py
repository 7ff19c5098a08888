"""Holiday ingestion: landed payloads to the raw table."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import instant, run_label, seconds_between
from tidemark.operators.contracts import DEFAULT_SOURCE, check_items, split_items, strict_records
from tidemark.session import materialise
from tidemark.sources.payloads import payload_items, read_bodies, rejected_bodies
from tidemark.sources.tables import RAW_HOLIDAYS, ensure_table, upsert

PLACE = ["path_no", "file", "block", "line_no", "item_no"]


@dataclass
class Ingested:
    metrics: DataFrame
    records: DataFrame | None = None
    rejects: DataFrame | None = None
    sample: DataFrame | None = None


def run_metrics(
    spark: SparkSession,
    pipeline: str,
    started: dt.datetime,
    ended: dt.datetime,
    status: str,
    received: int,
    loaded: int,
    error: str | None = None,
    execution_id: str | None = None,
) -> DataFrame:
    """One row of run metrics; without an id the start time makes one."""
    start, end = instant(started), instant(ended)
    return spark.range(1).select(
        F.lit(pipeline).alias("pipeline"),
        (F.lit(execution_id) if execution_id else run_label(start)).alias("execution_id"),
        start.alias("start_time"),
        end.alias("end_time"),
        F.lit(status).alias("status"),
        F.lit(received).cast("bigint").alias("records_received"),
        F.lit(loaded).cast("bigint").alias("records_loaded"),
        seconds_between(start, end).alias("duration_seconds"),
        F.lit(error).cast("string").alias("error_message"),
    )


def received_and_valid(items: DataFrame) -> DataFrame:
    """``records_received`` and the number that keep the contract, in one pass."""
    return check_items(items).agg(
        F.count(F.lit(1)).alias("records_received"),
        F.count_if(F.col("reject_reason").isNull()).alias("records_valid"),
    )


def dry_run_sample(records: DataFrame, order: list[str], rows: int = 3) -> DataFrame:
    """The first validated records in ``order``."""
    return records.orderBy(*order).limit(rows).select("date", "name", "type")


def ingest_holidays(
    spark: SparkSession,
    paths: list[str],
    table: str,
    now: dt.datetime | None = None,
    source: str = DEFAULT_SOURCE,
    mode: str = "strict",
    dry_run: bool = False,
    location: str | None = None,
    whole_files: bool = True,
    lenient_dates: bool = False,
    pipeline: str = "holidays",
) -> Ingested:
    """Scan, validate, key and upsert the payloads of ``paths``; never raises on bad data.

    ``strict`` fails the run on the first bad item or payload and loads
    nothing; ``quarantine`` loads the valid items and returns the others.
    ``records_loaded`` is the table's row count after the upsert, or in a dry
    run the number of valid items.  The job that writes the items down checks and
    counts them too, so that the payloads and the items are each read once.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"mode must be 'strict' or 'quarantine', not {mode!r}")
    started = now or dt.datetime.now(dt.timezone.utc)
    received = 0

    def finish(status: str, loaded: int, error: str | None = None, **results) -> Ingested:
        ended = dt.datetime.now(dt.timezone.utc) if now is None else now
        row = run_metrics(spark, pipeline, started, ended, status, received, loaded, error)
        return Ingested(row, **results)

    try:
        bodies = read_bodies(spark, paths, whole_files)
        seen = Observation("items")
        checked = check_items(payload_items(bodies, strict=mode == "strict"), lenient_dates).observe(
            seen,
            F.count(F.lit(1)).alias("received"),
            F.count_if(F.col("reject_reason").isNull()).alias("valid"),
        )
        items = materialise(checked, "items")
        received = seen.get.get("received", 0)
        rejects = None
        if mode == "strict":
            valid = strict_records(items, started, source, lenient_dates)
        else:
            valid, rejects = split_items(items, started, source, lenient_dates)
            unread = rejected_bodies(bodies).withColumn("item_no", F.lit(None).cast("int"))
            rejects = rejects.select(*PLACE, "reject_reason").unionByName(
                unread.select(*PLACE, "reject_reason")
            )
        results = {"records": valid, "rejects": rejects}
        if received == 0:
            return finish("SUCCESS", 0, **results)
        if dry_run:
            if mode == "strict":
                # Fails on a bad item, as a run that loads would.
                valid.write.format("noop").mode("overwrite").save()
            return finish("SUCCESS", seen.get["valid"], sample=dry_run_sample(valid, PLACE), **results)
        ensure_table(spark, table, RAW_HOLIDAYS, location)
        return finish("SUCCESS", upsert(valid, table, arrival=PLACE), **results)
    except Exception as error:
        # The run reports every failure as a row; the log keeps where it came from.
        logging.getLogger(__name__).exception("ingestion failed")
        return finish("FAILED", 0, str(error))
