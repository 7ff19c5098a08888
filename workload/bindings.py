"""Library inputs derived from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.budget import Budget
from tidemark.functions.keys import holiday_key

FIRST_DAY = dt.date(1995, 1, 1)
LAST_DAY = dt.date(2001, 12, 31)
NARROW_FIRST_DAY = dt.date(1996, 1, 1)
NARROW_LAST_DAY = dt.date(1999, 12, 31)
INGESTED_AT = dt.datetime(2026, 1, 5, 12, 0, 0)

# National holidays on fixed dates: month and day, name.
FIXED_HOLIDAYS = {
    "0101": "Confraternização Universal",
    "0421": "Tiradentes",
    "0501": "Dia do Trabalho",
    "0907": "Independência do Brasil",
    "1012": "Nossa Senhora Aparecida",
    "1102": "Finados",
    "1115": "Proclamação da República",
    "1225": "Natal",
}
# Dates that are a city's holiday as well.
CITY_HOLIDAYS = {"0907": "Aniversário da Cidade", "1225": "Aniversário da Cidade"}

BUDGET = Budget(free_tier_bytes=800_000_000, max_bytes_per_query=45_000_000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sales(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Line items as raw sales.

    Dimensions join by their primary keys, and only those that ``columns``
    need: a left join on a unique key changes no row, so it can be left out.
    """
    computed = {
        "sale_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "sale_date": F.col("l_shipdate").cast("date"),
        "product_id": F.col("l_partkey").cast("string"),
        "product_category": F.col("p_type"),
        "quantity": F.col("l_quantity"),
        "unit_price": F.col("p_retailprice"),
        "revenue": F.col("l_extendedprice"),
        "region": F.col("r_name"),
    }
    wanted = columns or list(computed)
    df = table(spark, sf_dir, "lineitem")
    if {"product_category", "unit_price"} & set(wanted):
        part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
        df = df.join(part, "l_partkey", "left")
    if "region" in wanted:
        # One after the other, so that each join is planned from the size of one file.
        df = (
            df.join(
                table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey", "left"
            )
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        )
    return df.select(*(computed[name].alias(name) for name in wanted))


def raw_holidays(spark: SparkSession, sf_dir: str, city: bool = False) -> DataFrame:
    """Holiday records with many copies: every order placed on a holiday brings one.

    ``city`` adds a second holiday on some dates.
    """
    orders = table(spark, sf_dir, "orders")
    records = _holiday_records(orders, FIXED_HOLIDAYS, "national")
    if city:
        records = records.unionByName(_holiday_records(orders, CITY_HOLIDAYS, "municipal"))
    return records


def _holiday_records(orders: DataFrame, names: dict[str, str], kind: str) -> DataFrame:
    month_day = F.date_format("o_orderdate", "MMdd")
    name = F.lit(None).cast("string")
    for key, value in names.items():
        name = F.when(month_day == key, value).otherwise(name)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    placed = F.col("o_orderdate").cast("timestamp")
    return orders.where(month_day.isin(list(names))).select(
        holiday_key(day, name, F.lit(kind)).alias("holiday_id"),
        day.alias("date"),
        F.concat(F.lit("\u00a0 "), name, F.lit("\t")).alias("name"),
        F.lit(f" {kind.title()} ").alias("type"),
        F.col("o_orderpriority").alias("source"),
        F.timestamp_seconds(F.unix_seconds(placed) + F.col("o_orderkey")).alias("ingested_at"),
        F.col("o_orderstatus"),
    )


def event_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw holidays: few keys, each with very many copies."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select(
        holiday_key(day, F.col("event_type"), F.lit("national")).alias("holiday_id"),
        day.alias("date"),
        F.concat(F.lit("  "), F.initcap("event_type"), F.lit("\u3000")).alias("name"),
        F.lit("NATIONAL ").alias("type"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("source"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )


def dirty_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as payload items; weekday, event type and hour decide what is broken."""
    weekday, hour, kind = F.dayofweek("ts"), F.hour("ts"), F.col("event_type")
    day = (
        F.when(weekday == 1, F.date_format("ts", "dd/MM/yyyy"))
        .when(weekday == 2, F.lit("2024-02-30"))
        .when(weekday == 3, F.date_format("ts", "yyyyMMdd"))
        .when(weekday != 4, F.date_format("ts", "yyyy-MM-dd"))
    )
    name = (
        F.when(kind == "error", F.lit(" \t\u00a0"))
        .when(kind == "click", F.concat(F.lit("\u2003"), kind, F.lit("\u00a0")))
        .when(kind != "signup", kind)
    )
    holiday_type = F.when(hour == 3, "").when(hour != 5, " National ")
    return table(spark, sf_dir, "events").select(
        "event_id", day.alias("date"), name.alias("name"), holiday_type.alias("type"), "ts"
    )


def payload_bodies(spark: SparkSession, sf_dir: str, per_body: int = 100) -> DataFrame:
    """All events as payload bodies of at most ``per_body`` items (event ids are unique).

    A body that starts with an error event is an error object instead of a list.
    """
    body_no = F.expr(f"event_id div {per_body}")
    item = F.struct(
        F.col("event_id"),
        F.struct(
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            F.col("event_type").alias("name"),
            F.lit("National").alias("type"),
            F.col("user_id").alias("unknown"),
        ).alias("item"),
    )
    bodies = (
        table(spark, sf_dir, "events")
        .groupBy(body_no.alias("body_no"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    listed = F.to_json(F.col("items.item"))
    failed = F.to_json(F.struct(F.lit("rate limit").alias("message"), F.col("body_no")))
    starts_with_error = F.col("items")[0]["item"]["name"] == "error"
    return bodies.select("body_no", F.when(starts_with_error, failed).otherwise(listed).alias("value"))



def job_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as query jobs: a project per priority, bytes from the total price.

    Billed bytes round up to whole MiB; running jobs (open orders) have none.
    """
    started = F.col("o_orderdate").cast("timestamp")
    estimate = F.round(F.col("o_totalprice") * 100).cast("bigint")
    state = F.when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("DONE")
    billed = F.when(
        F.col("o_orderstatus") != "O", F.ceil(estimate / F.lit(1048576)).cast("bigint") * 1048576
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.col("o_custkey")).alias("execution_id"),
        F.lit("query").alias("step_name"),
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.col("o_orderpriority").alias("project_id"),
        started.alias("start_time"),
        F.timestamp_seconds(F.unix_seconds(started) + F.col("o_orderkey") % 600).alias("end_time"),
        estimate.alias("estimated_bytes"),
        estimate.alias("bytes_processed"),
        billed.alias("bytes_billed"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS")
        .when(F.col("o_orderstatus") == "P", "ERROR")
        .otherwise("RUNNING")
        .alias("status"),
        state.alias("state"),
    )
