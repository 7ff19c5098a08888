"""Queries over the test tables, one per operator or result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates as date_functions
from tidemark.functions.keys import holiday_key
from tidemark.operators import checks, contracts, distinct
from tidemark.operators.latest import overlay
from tidemark.operators.nearest import nearest_dates
from tidemark.operators.ordered import nearest_marks
from tidemark.plans import calendar, ingest, opportunities, quality, sales, staging, usage
from tidemark.plans.models import build_models
from tidemark.session import materialise, scratch_path, use_utc
from tidemark.sources import ledger as ledgers
from tidemark.sources import payloads, tables, versions
from tidemark.sources.sales import read_sales_csv
from workload import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(use_utc(spark), str(sf_dir).rstrip("/")))

    QUERIES[function.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Types that every SQL engine compares alike: decimals as doubles, instants as UTC wall time."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*(column(field) for field in df.schema))


def _holidays(spark: SparkSession, sf_dir: str, city: bool = False) -> DataFrame:
    return materialise(staging.stg_holidays(b.raw_holidays(spark, sf_dir, city)), "stg_holidays")


def _calendar(spark: SparkSession, sf_dir: str, city: bool = False, **options) -> DataFrame:
    return _calendar_of(_holidays(spark, sf_dir, city), **options)


def _calendar_of(holidays: DataFrame, **options) -> DataFrame:
    return calendar.commercial_calendar(
        holidays.sparkSession, holidays, b.FIRST_DAY, b.LAST_DAY, **options
    )


def _dim(spark: SparkSession, sf_dir: str, city: bool = False) -> DataFrame:
    return _dim_of(_holidays(spark, sf_dir, city))


def _dim_of(holidays: DataFrame) -> DataFrame:
    return materialise(calendar.dim_calendar(_calendar_of(holidays)), "dim_calendar")


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_sales(b.raw_sales(spark, sf_dir))


def _facts(spark: SparkSession, sf_dir: str, holidays: DataFrame) -> DataFrame:
    return sales.fct_sales(_sales(spark, sf_dir), _dim_of(holidays))


def _in_thousandths(raw: DataFrame, column: str) -> DataFrame:
    """Raw sales with an amount of five decimals."""
    exact = F.col(column).cast("decimal(18,2)") * F.lit("0.001").cast("decimal(4,3)")
    return raw.withColumn(column, exact)


# --- calendar -------------------------------------------------------------------


@query
def date_spine(spark, sf_dir):
    span = calendar.span_of(b.table(spark, sf_dir, "orders"), "o_orderdate")
    return calendar.date_spine(spark, *span)


@query
def calendar_parts(spark, sf_dir):
    span = calendar.span_of(b.table(spark, sf_dir, "orders"), "o_orderdate")
    return calendar.calendar_parts(calendar.date_spine(spark, *span))


@query
def nearest_holiday(spark, sf_dir):
    near = nearest_dates(
        calendar.date_spine(spark, b.FIRST_DAY, b.LAST_DAY),
        _holidays(spark, sf_dir).select("holiday_date"),
    )
    return near.select(
        "calendar_date",
        F.col("next_date").alias("next_holiday_date"),
        F.datediff("next_date", "calendar_date").alias("days_to_holiday"),
        F.col("prev_date").alias("prev_holiday_date"),
        F.datediff("calendar_date", "prev_date").alias("days_after_holiday"),
    )


@query
def commercial_calendar(spark, sf_dir):
    return _calendar(spark, sf_dir)


@query
def commercial_calendar_duplicate_dates(spark, sf_dir):
    return _calendar(spark, sf_dir, city=True)


@query
def commercial_calendar_first_of_date(spark, sf_dir):
    return _calendar(spark, sf_dir, city=True, on_duplicate_date="first")


@query
def commercial_calendar_no_holidays(spark, sf_dir):
    span = calendar.span_of(b.table(spark, sf_dir, "orders"), "o_orderdate")
    # The table is written, so that the filter reads it and finds none.
    none = _holidays(spark, sf_dir).where("holiday_type = 'state'")
    return calendar.commercial_calendar(spark, none, *span)


@query
def dim_calendar(spark, sf_dir):
    return calendar.dim_calendar(_calendar(spark, sf_dir))


@query
def materialised_calendar(spark, sf_dir):
    view = "calendar_" + scratch_path(spark, "view").rsplit("-", 1)[1]
    tables.register_view(materialise(_calendar(spark, sf_dir), "commercial_calendar"), view)
    return tables.source(spark, view)


# --- staging and ingestion ------------------------------------------------------


@query
def stg_sales(spark, sf_dir):
    return _sales(spark, sf_dir)


@query
def stg_sales_sub_cent(spark, sf_dir):
    return staging.stg_sales(_in_thousandths(b.raw_sales(spark, sf_dir), "unit_price"))


@query
def stg_holidays(spark, sf_dir):
    return staging.stg_holidays(b.event_holidays(spark, sf_dir))


@query
def holiday_keys(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd")
    return b.table(spark, sf_dir, "events").select(
        "event_id", holiday_key(day, F.upper("event_type"), F.lit("National")).alias("holiday_id")
    )


@query
def validate_valid(spark, sf_dir):
    records, _ = contracts.split_items(b.dirty_items(spark, sf_dir), b.INGESTED_AT, "events")
    return records.drop("ts")


@query
def validate_rejects(spark, sf_dir):
    _, rejects = contracts.split_items(b.dirty_items(spark, sf_dir), b.INGESTED_AT, "events")
    return rejects.select("event_id", "reject_reason")


@query
def validate_lenient(spark, sf_dir):
    records, _ = contracts.split_items(
        b.dirty_items(spark, sf_dir), F.col("ts"), "events", lenient_dates=True
    )
    return records.drop("ts")


def _landed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "payloads")
    b.payload_bodies(spark, sf_dir).select("value").write.text(path)
    return payloads.read_bodies(spark, [path], whole_files=False)


@query
def payload_scan(spark, sf_dir):
    items = payloads.payload_items(_landed_bodies(spark, sf_dir))
    return items.select("date", "name", "type", "reject_reason")


@query
def payload_rejected_files(spark, sf_dir):
    rejected = payloads.rejected_bodies(_landed_bodies(spark, sf_dir))
    return rejected.select("body", "reject_reason")


def _record_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw holiday records of open orders as a batch, those of the other orders as the table."""
    raw = b.raw_holidays(spark, sf_dir)
    existing = raw.where("o_orderstatus <> 'O'").drop("o_orderstatus")
    one_each = staging.latest_by(existing, ["holiday_id"], [F.desc("ingested_at")])
    batch = raw.where("o_orderstatus = 'O'").drop("o_orderstatus")
    return one_each, batch.withColumn("arrival", F.unix_micros("ingested_at"))


@query
def holiday_upsert(spark, sf_dir):
    existing, batch = _record_parts(spark, sf_dir)
    return overlay(existing, batch, ["holiday_id"], ["arrival"])


@query
def upsert_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw_holidays")
    name = "raw_holidays_" + path.rsplit("-", 1)[1]
    tables.ensure_table(spark, name, location=path)
    existing, batch = (
        part.withColumn("date", F.col("date").cast("date")) for part in _record_parts(spark, sf_dir)
    )
    # Loading the batch again must change nothing.
    tables.upsert(existing, name)
    tables.upsert(batch, name, arrival=["arrival"])
    tables.upsert(batch, name, arrival=["arrival"])
    return tables.source(spark, name, contracts.RECORD_COLUMNS)


@query
def versioned_upsert(spark, sf_dir):
    """The records of ``upsert_roundtrip`` in a table of versions, whose readers never see a change half made."""
    root = scratch_path(spark, "versions")
    existing, batch = (part.withColumn("date", F.col("date").cast("date")) for part in _record_parts(spark, sf_dir))
    year, clustering = F.year("date"), tables.HOLIDAY_CLUSTERING
    versions.upsert(existing.withColumn("arrival", F.lit(0)), root, "holiday_id", ["arrival"], year, clustering)
    for _ in range(2):
        versions.upsert(batch, root, "holiday_id", ["arrival"], year, clustering)
    return versions.rows_of(spark, root, versions.current(spark, root)).select(*contracts.RECORD_COLUMNS)


@query
def append_readback(spark, sf_dir):
    path = scratch_path(spark, "messages")
    name = "messages_" + path.rsplit("-", 1)[1]
    tables.ensure_table(
        spark, name, "id string, message string, created_at timestamp", path, by_year_of=None
    )
    events = b.table(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), "user_id").alias("id"),
        F.col("event_type").alias("message"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )
    tables.append(events.where("message = 'error'"), name)
    tables.append(events.where("message <> 'error'"), name)
    return tables.read_by_key(spark, name, "id", "user-8", ["id", "message", "created_at"])


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "sales-csv")
    raw = staging.stg_sales(b.raw_sales(spark, sf_dir))
    raw.write.csv(path, header=True)
    return staging.stg_sales(read_sales_csv(spark, path))


@query
def run_metrics(spark, sf_dir):
    items = payloads.payload_items(_landed_bodies(spark, sf_dir))
    counts = ingest.received_and_valid(items).first()
    return ingest.run_metrics(
        spark,
        "holidays",
        b.INGESTED_AT,
        b.INGESTED_AT.replace(second=2, microsecond=345000),
        "SUCCESS",
        counts["records_received"],
        counts["records_valid"],
    )


@query
def dry_run_sample(spark, sf_dir):
    records, _ = contracts.split_items(b.dirty_items(spark, sf_dir), b.INGESTED_AT, "events")
    return ingest.dry_run_sample(records, ["event_id"])


@query
def holiday_ingest(spark, sf_dir):
    """Payload files to the raw table, bad payloads set aside."""
    path = scratch_path(spark, "payloads")
    b.payload_bodies(spark, sf_dir).select("value").write.text(path)
    target = scratch_path(spark, "raw_holidays")
    name = "ingested_" + target.rsplit("-", 1)[1]
    done = ingest.ingest_holidays(
        spark, [path], name, b.INGESTED_AT, "events", "quarantine", location=target, whole_files=False
    )
    metrics = done.metrics.first()
    return tables.source(spark, name, contracts.RECORD_COLUMNS).select(
        "*",
        F.lit(metrics["status"]).alias("status"),
        F.lit(metrics["records_received"]).cast("bigint").alias("records_received"),
        F.lit(metrics["records_loaded"]).cast("bigint").alias("records_loaded"),
    )


@query
def holiday_ingest_years(spark, sf_dir):
    """The landed responses of each year, one per month, each read whole, strictly: the form in which years are fetched."""
    folder = scratch_path(spark, "years")
    item = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_type").alias("name"), F.lit("National").alias("type"))
    of_day = b.table(spark, sf_dir, "events").select(F.year("ts").alias("year"), F.month("ts").alias("month"), item.alias("item"))
    # A group holds the different kinds of events of a month's days, whatever the number of events.
    months = of_day.distinct().groupBy("year", "month").agg(F.to_json(F.sort_array(F.collect_list("item"))).alias("value"))
    responses = materialise(months, "responses")
    years = sorted(row["year"] for row in responses.select("year").distinct().collect())
    paths = payloads.year_paths(folder, years)
    for year, path in zip(years, paths):
        responses.where(F.col("year") == year).select("value").write.option("maxRecordsPerFile", 1).text(path)
    target = scratch_path(spark, "raw_holidays")
    name = "yearly_" + target.rsplit("-", 1)[1]
    done = ingest.ingest_holidays(spark, paths, name, b.INGESTED_AT, "events", "strict", location=target)
    return tables.source(spark, name, contracts.RECORD_COLUMNS).crossJoin(
        F.broadcast(done.metrics.select("status", "records_received", "records_loaded"))
    )


# --- sales and opportunities ----------------------------------------------------


@query
def fct_sales(spark, sf_dir):
    return sales.fct_sales(_sales(spark, sf_dir), _dim(spark, sf_dir))


@query
def fct_sales_duplicate_dates(spark, sf_dir):
    return sales.fct_sales(_sales(spark, sf_dir), _dim(spark, sf_dir, city=True))


@query
def sales_by_context(spark, sf_dir):
    return sales.sales_by_context(b.raw_sales(spark, sf_dir, ["sale_date"]), _dim(spark, sf_dir))


@query
def sales_outside_calendar(spark, sf_dir):
    narrow = calendar.dim_calendar(
        calendar.commercial_calendar(
            spark, _holidays(spark, sf_dir), b.NARROW_FIRST_DAY, b.NARROW_LAST_DAY
        )
    )
    outside = b.raw_sales(spark, sf_dir, ["sale_id", "sale_date", "revenue"])
    return sales.sales_outside_calendar(outside, materialise(narrow, "dim_calendar"))


@query
def baseline_sales(spark, sf_dir):
    return opportunities.baseline_sales(_facts(spark, sf_dir, _holidays(spark, sf_dir)))


@query
def baseline_sales_sub_cent(spark, sf_dir):
    raw = _in_thousandths(b.raw_sales(spark, sf_dir), "revenue")
    facts = sales.fct_sales(staging.stg_sales(raw), _dim(spark, sf_dir))
    return opportunities.baseline_sales(facts).select("product_category", "avg_revenue_normal")


@query
def pre_holiday_sales(spark, sf_dir):
    holidays = _holidays(spark, sf_dir)
    facts = opportunities.with_next_holiday(_facts(spark, sf_dir, holidays), holidays)
    return opportunities.pre_holiday_sales(facts)


@query
def transactions_before_holidays(spark, sf_dir):
    """From states of two batches of sales, merged; the second keeps the numbers of the first."""
    holidays, keys = _holidays(spark, sf_dir), ["sale_date", "product_category"]
    sold = _sales(spark, sf_dir)
    early = F.year("sale_date") % 2 == 0
    numbers, parts = None, []
    for batch in (sold.where(early), sold.where(~early | F.col("sale_date").isNull())):
        numbers = distinct.numbered(batch, "sale_id", ["sale_date", "product_category"], numbers)
        parts.append(materialise(distinct.states(batch, "sale_id", keys, numbers), "sale_states"))
    days = opportunities.days_before_holidays(_dim_of(holidays), holidays)
    return opportunities.transactions_before_holidays(parts[0].unionByName(parts[1]), days)


@query
def mart_opportunities(spark, sf_dir):
    holidays = _holidays(spark, sf_dir)
    return opportunities.mart_opportunities(_facts(spark, sf_dir, holidays), holidays)


@query
def mart_opportunities_as_written(spark, sf_dir):
    facts = _facts(spark, sf_dir, _holidays(spark, sf_dir))
    return opportunities.mart_opportunities_as_written(facts)


# --- data tests -----------------------------------------------------------------


def _line_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales under a key that is not unique, with the calendar context."""
    line = b.table(spark, sf_dir, "lineitem")
    return line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
        F.col("l_orderkey"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("discount"),
        F.col("l_returnflag").alias("flag"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_tax") * 20)).cast("decimal(18,2)").alias("revenue"),
        (F.col("l_quantity").cast("bigint") - 1).alias("quantity"),
    )


@query
def positive_revenue_violations(spark, sf_dir):
    return quality.positive_revenue_violations(_line_sales(spark, sf_dir))


@query
def dq_unique(spark, sf_dir):
    return checks.unique(_line_sales(spark, sf_dir), "sale_id")


@query
def dq_not_null(spark, sf_dir):
    return checks.not_null(_line_sales(spark, sf_dir), "discount").select("sale_id", "flag")


@query
def dq_accepted_values(spark, sf_dir):
    return checks.accepted_values(_line_sales(spark, sf_dir), "flag", ["A", "N"])


@query
def dq_relationships(spark, sf_dir):
    # Labels cover some of the documents.
    labels, documents = b.table(spark, sf_dir, "labels"), b.table(spark, sf_dir, "documents")
    return checks.relationships(documents, "doc_id", labels, "doc_id")


@query
def data_quality_report(spark, sf_dir):
    # Raw sales are a table: written once, the tests read single columns of it.
    raw_sales = materialise(b.raw_sales(spark, sf_dir), "raw_sales")
    raw_holidays = b.raw_holidays(spark, sf_dir, city=True)
    return quality.data_quality_report(build_models(raw_holidays, raw_sales, b.FIRST_DAY, b.LAST_DAY))


# --- usage ledger ---------------------------------------------------------------


@query
def monthly_usage(spark, sf_dir):
    return usage.monthly_usage(usage.billed_jobs(b.job_ledger(spark, sf_dir)))


@query
def monthly_usage_success_only(spark, sf_dir):
    return usage.monthly_usage(b.job_ledger(spark, sf_dir), status="SUCCESS")


@query
def current_month_usage(spark, sf_dir):
    jobs = usage.successful_records(b.job_ledger(spark, sf_dir))
    return usage.usage_of_month(jobs, b.dt.datetime(2001, 7, 15, 8, 30))


@query
def alert_levels(spark, sf_dir):
    used = usage.monthly_usage(usage.billed_jobs(b.job_ledger(spark, sf_dir)))
    return usage.with_alert_level(used, b.BUDGET)


@query
def usage_summary(spark, sf_dir):
    used = usage.monthly_usage(usage.billed_jobs(b.job_ledger(spark, sf_dir)))
    return usage.usage_summary(used, b.BUDGET)


@query
def idle_project_summary(spark, sf_dir):
    """The month of a date for projects that may have run nothing."""
    jobs = usage.billed_jobs(b.job_ledger(spark, sf_dir))
    idle = b.table(spark, sf_dir, "region").select(F.concat(F.lit("idle-"), "r_name").alias("project_id"))
    projects = b.job_ledger(spark, sf_dir).select("project_id").unionByName(idle)
    used = usage.usage_of_month(jobs, b.dt.datetime(2001, 7, 15, 8, 30), projects=projects)
    return usage.usage_summary(used, b.BUDGET)


@query
def request_verdicts(spark, sf_dir):
    """Running jobs as requests, judged against what the finished ones used."""
    jobs = b.job_ledger(spark, sf_dir)
    requests = jobs.where("state = 'RUNNING'").select(
        "project_id",
        date_functions.month_start(F.col("start_time")).alias("month"),
        "job_id",
        "estimated_bytes",
    )
    used = usage.monthly_usage(usage.billed_jobs(jobs))
    return usage.request_verdicts(requests, used, b.BUDGET).drop("bytes_used_month")


@query
def job_costs(spark, sf_dir):
    return usage.job_costs(b.job_ledger(spark, sf_dir), b.BUDGET)


@query
def job_costs_with_gaps(spark, sf_dir):
    """Costs where records lack a project or a start time, and a third of them share one instant."""
    number = F.col("job_id").cast("bigint")
    gaps = b.job_ledger(spark, sf_dir).withColumns(
        {
            "project_id": F.when(number % 5 != 0, F.col("project_id")),
            "start_time": F.when(number % 3 == 0, F.lit("1996-02-29 12:00:00").cast("timestamp")).when(
                number % 7 != 0, F.col("start_time")
            ),
        }
    )
    return usage.job_costs(gaps, b.BUDGET)


@query
def nearest_events(spark, sf_dir):
    """The events next to the time of each order, moved into their span, of all kinds."""
    return nearest_marks(_order_times(spark, sf_dir), b.table(spark, sf_dir, "events").select(F.col("ts").alias("moment")), "moment")


@query
def nearest_events_of_kind(spark, sf_dir):
    """The events next to the time of each order among those of the kind that its priority stands for."""
    events = b.table(spark, sf_dir, "events").select("event_type", F.col("ts").alias("moment"))
    return nearest_marks(_order_times(spark, sf_dir), events, "moment", ("event_type",))


def _order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders at an instant of 2024; every seventh at the start of the year, some without one."""
    key = F.col("o_orderkey")
    second = F.pmod(key * 7919, F.lit(31 * 86400))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    at = F.when(key % 7 == 0, start).when(key % 11 != 0, F.timestamp_add("SECOND", second, start))
    kinds = F.array(*(F.lit(kind) for kind in ("click", "view", "purchase", "error", None)))
    kind = F.element_at(kinds, F.left("o_orderpriority", F.lit(1)).cast("int"))
    return b.table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("event_type"), at.alias("moment"))


@query
def ledger_retention(spark, sf_dir):
    kept = usage.retained(b.job_ledger(spark, sf_dir))
    return kept.select("project_id", "job_id", "start_time", "bytes_billed")


@query
def ledger_append_retention(spark, sf_dir):
    """The ledger appended in four batches; each append keeps the newest records of a project."""
    root = scratch_path(spark, "kept-ledger")
    jobs = b.job_ledger(spark, sf_dir).select("project_id", "job_id", "start_time", "bytes_billed")
    for part in range(4):
        batch = jobs.where(F.pmod(F.xxhash64("job_id"), F.lit(4)) == part)
        versions.append_newest(batch, root, "project_id", ["start_time", "job_id"])
    return versions.newest_rows(spark, root)


@query
def restricted_projects(spark, sf_dir):
    jobs = usage.restricted_jobs(b.job_ledger(spark, sf_dir), ["Urgent", "low"])
    return jobs.select("project_id", "job_id")


@query
def ledger_import(spark, sf_dir):
    """Ledger written as JSON, imported, appended to the parquet ledger in two batches."""
    landed = scratch_path(spark, "ledger-json")
    jobs = usage.with_alert_level(
        b.job_ledger(spark, sf_dir).withColumn("bytes_used_month", F.coalesce("bytes_billed", F.lit(0))),
        b.BUDGET,
    ).withColumn("estimated_cost_usd", usage.cost_usd(F.col("bytes_used_month"), b.BUDGET))
    jobs.drop("estimated_bytes", "state", "bytes_used_month").write.json(landed)
    # Written once, so that an append parses nothing again.
    imported = materialise(ledgers.read_json_ledger(spark, landed, lines=True), "imported-ledger")
    path = scratch_path(spark, "ledger")
    ledgers.append_ledger(imported.where("status = 'SUCCESS'"), path)
    ledgers.append_ledger(imported.where("status <> 'SUCCESS'"), path)
    stored = ledgers.read_ledger(spark, path)
    return stored.withColumn("run_month", date_functions.month_label(F.col("start_time")))


def _dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger records as JSON text: some without ids, some with a fraction of a byte, some broken."""
    jobs = b.job_ledger(spark, sf_dir)
    number = F.col("job_id").cast("bigint")
    named = number % 7 != 0
    record = F.struct(
        F.when(named, F.col("job_id")).alias("job_id"),
        F.when(named, F.col("execution_id")).alias("execution_id"),
        "project_id",
        F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("start_time"),
        "status",
        F.when(number % 11 == 0, F.col("bytes_billed") + F.lit("0.25").cast("decimal(3,2)"))
        .otherwise(F.col("bytes_billed").cast("decimal(20,0)"))
        .alias("bytes_billed"),
        F.when(number % 17 == 0, "yesterday").alias("end_time"),
    )
    value = F.when(number % 13 == 0, F.concat(F.lit('{"job_id": '), "job_id")).otherwise(F.to_json(record))
    return jobs.select(F.trunc("start_time", "month").alias("month"), number.alias("number"), value.alias("value"))


_SEEN = ("job_id", "execution_id", "project_id", "start_time", "status", "bytes_billed", "end_time", "reject_reason")


@query
def ledger_items(spark, sf_dir):
    """A line-wise ledger with records that do not fit; none is lost."""
    landed = scratch_path(spark, "ledger-lines")
    _dirty_records(spark, sf_dir).select("value").write.text(landed)
    return ledgers.ledger_items(spark, landed, lines=True).select(*_SEEN)


#: About as many records, of some hundred bytes each, make an array file.
_PER_FILE = 10_000


def _write_arrays(records, path, per_file=_PER_FILE):
    """Records (month, number, value) as array files of about ``per_file`` records, as many a month as it takes."""
    files = records.groupBy(F.col("month").alias("_month")).agg(F.ceil(F.count("*") / per_file).alias("_files"))
    part = F.pmod(F.xxhash64("number", "value"), F.col("_files")).alias("part")
    dealt = records.join(F.broadcast(files), F.col("month").eqNullSafe(F.col("_month")))
    listed = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("value")), ",\n"), F.lit("]"))
    arrays = dealt.groupBy("month", part).agg(listed.alias("value"))
    # A folder per array, as arrays that share a file are no array.
    arrays.write.partitionBy("month", "part").text(path)


@query
def ledger_usage_from_arrays(spark, sf_dir):
    """Bytes per project and month of a ledger of array files, of which a month has as many as its records fill.

    The broken records have no project and no month.
    """
    landed = scratch_path(spark, "ledger-arrays")
    _write_arrays(_dirty_records(spark, sf_dir), landed)
    return usage.monthly_usage(ledgers.read_json_ledger(spark, f"{landed}/*/*"), status="SUCCESS")


@query
def ledger_items_from_arrays(spark, sf_dir):
    """The records of ``ledger_items`` from array files: the same rows, the broken ones set aside one by one."""
    landed = scratch_path(spark, "ledger-arrays")
    _write_arrays(_dirty_records(spark, sf_dir), landed)
    return ledgers.ledger_items(spark, f"{landed}/*/*").select(*_SEEN)
