import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import contracts
from tidemark.plans.ingest import ingest_holidays
from tidemark.sources import ledger, payloads, tables
from tidemark.sources.sales import read_sales_csv
from tidemark.plans.staging import stg_sales
from workload import registry

NOW = dt.datetime(2026, 1, 5, 12)
ITEM = "date string, name string, type string"


def items(spark, *rows):
    return spark.createDataFrame(list(rows), ITEM)


def land(folder, name, body):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(body if isinstance(body, str) else json.dumps(body, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_valid_items_become_keyed_records(spark):
    records, rejects = contracts.split_items(
        items(spark, ("2026-01-01", " Confraternização mundial ", "National"), ("2026-04-21", "Tiradentes", "national")),
        NOW,
    )
    rows = records.orderBy("date").collect()
    assert rejects.count() == 0 and len(rows) == 2
    assert (rows[0]["name"], rows[0]["type"], rows[0]["source"]) == ("Confraternização mundial", "national", "BrasilAPI")
    assert rows[1]["holiday_id"] == "b043493920ba2dd72426919eada1fdf702c34648be64c8a16d2a692c17d02bfe"
    assert rows[0]["ingested_at"] == NOW


def test_same_triple_same_key(spark):
    records, _ = contracts.split_items(
        items(spark, ("2026-04-21", "TIRADENTES", "national"), ("2026-04-21", " Tiradentes", " NATIONAL")), NOW
    )
    assert records.select("holiday_id").distinct().count() == 1


@pytest.mark.parametrize(
    "item, reason",
    [
        (("01/01/2026", "a", "b"), "date: not YYYY-MM-DD"),
        (("2026-02-30", "a", "b"), "date: not YYYY-MM-DD"),
        ((None, "a", "b"), "date: missing"),
        (("2026-01-01", None, "b"), "name: missing"),
        (("2026-01-01", "  \t", "b"), "name: blank"),
        (("2026-01-01", "a", None), "type: missing"),
        (("2026-01-01", "a", "\u001f"), "type: blank"),
    ],
)
def test_broken_items_name_their_reason(spark, item, reason):
    checked = contracts.check_items(items(spark, item)).first()
    assert checked["reject_reason"] == reason


def test_strict_mode_fails_the_whole_batch(spark):
    good, bad = ("2026-01-01", "a", "b"), ("01/01/2026", "a", "b")
    assert contracts.strict_records(items(spark, good), NOW).count() == 1
    with pytest.raises(Exception, match="not YYYY-MM-DD"):
        contracts.strict_records(items(spark, good, bad), NOW).collect()


def test_payload_scan(spark, tmp_path):
    first = land(
        tmp_path / "p",
        "2026.json",
        [
            {"date": "2026-01-01", "name": "Ano", "type": "national", "extra": [1, {"a": 2}]},
            {"date": 20260101, "name": None, "type": "x"},
            3,
            {"name": "só"},
            '{"date": "2026-01-01", "name": "quoted", "type": "x"}',
            None,
            {"date": "2026-01-02", "name": "a", "type": "b"},
        ],
    )
    second = land(tmp_path / "p", "2025.json", '{"message": "no"}')
    bodies = payloads.read_bodies(spark, [first, first, second])
    found = payloads.payload_items(bodies).orderBy("path_no", "item_no").collect()
    assert [(r["date"], r["name"], r["type"], r["reject_reason"]) for r in found[:7]] == [
        ("2026-01-01", "Ano", "national", None),
        ("20260101", None, "x", "date: not text"),
        (None, None, None, "item: not an object"),
        (None, "só", None, None),
        (None, None, None, "item: not an object"),
        (None, None, None, "item: not an object"),
        ("2026-01-02", "a", "b", None),
    ]
    assert len(found) == 14
    assert payloads.rejected_bodies(bodies).select("file").first()[0].endswith("2025.json")
    with pytest.raises(Exception, match="not a list"):
        payloads.payload_items(bodies, strict=True).collect()


def test_years_select_their_files(spark, tmp_path):
    for year in (2024, 2025, 2026):
        land(tmp_path / "y", f"{year}.json", [{"date": f"{year}-01-01", "name": "Ano", "type": "national"}])
    bodies = payloads.read_bodies(spark, payloads.year_paths(str(tmp_path / "y"), [2026, 2024]))
    found = payloads.payload_items(bodies).orderBy("path_no").collect()
    assert [r["date"] for r in found] == ["2026-01-01", "2024-01-01"]


def table_rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("date", "name", "type").collect())


def test_ingest_is_idempotent_and_last_write_wins(spark, tmp_path):
    day = {"date": "2026-12-25", "name": "Natal", "type": "national"}
    old = land(tmp_path / "in", "a.json", [day, {"date": "2025-12-25", "name": "Natal", "type": "national"}])
    new = land(tmp_path / "in", "b.json", [dict(day, name="NATAL"), dict(day, name="natal ")])
    table, place = "ingest_twice", str(tmp_path / "table")

    def metrics(*paths, **options):
        return ingest_holidays(spark, list(paths), table, NOW, location=place, **options).metrics.first()

    assert metrics(old)["records_loaded"] == 2
    again = metrics(old)
    assert (again["status"], again["records_received"], again["records_loaded"]) == ("SUCCESS", 2, 2)
    # The key ignores case; of the two new records the later one stays, and the other year is untouched.
    assert metrics(new)["records_loaded"] == 2
    assert table_rows(spark, table) == [
        (dt.date(2025, 12, 25), "Natal", "national"),
        (dt.date(2026, 12, 25), "natal", "national"),
    ]
    # Paths count in the order given.
    assert metrics(new, old)["records_loaded"] == 2
    assert table_rows(spark, table)[1][1] == "Natal"


def test_ingest_failure_loads_nothing(spark, tmp_path):
    bad = land(tmp_path / "bad", "a.json", [{"date": "2026-01-01", "name": "a", "type": "b"}, {"date": "x"}])
    done = ingest_holidays(spark, [bad], "ingest_bad", NOW, location=str(tmp_path / "t"))
    row = done.metrics.first()
    assert (row["status"], row["records_received"], row["records_loaded"]) == ("FAILED", 2, 0)
    assert "not YYYY-MM-DD" in row["error_message"]
    kept = ingest_holidays(spark, [bad], "ingest_bad", NOW, mode="quarantine", location=str(tmp_path / "t"))
    assert kept.metrics.first()["records_loaded"] == 1
    assert [r["reject_reason"] for r in kept.rejects.collect()] == ["date: not YYYY-MM-DD"]


def test_dry_run_and_empty_run(spark, tmp_path):
    rows = [{"date": f"2026-01-0{i}", "name": "a", "type": "b"} for i in (4, 2, 3, 1)]
    path = land(tmp_path / "dry", "a.json", rows)
    done = ingest_holidays(spark, [path], "never_made", NOW, dry_run=True)
    row = done.metrics.first()
    assert (row["status"], row["records_received"], row["records_loaded"]) == ("SUCCESS", 4, 4)
    assert [str(r["date"]) for r in done.sample.collect()] == ["2026-01-04", "2026-01-02", "2026-01-03"]
    assert not spark.catalog.tableExists("never_made")
    empty = land(tmp_path / "dry", "b.json", [])
    assert ingest_holidays(spark, [empty], "never_made", NOW).metrics.first()["records_loaded"] == 0


def test_figures_come_from_the_writing_job(spark, tmp_path, monkeypatch):
    """No pass over the items is made to count them."""
    landed = land(tmp_path / "in", "2024.json", json.dumps([{"date": "2024-01-01", "name": "A", "type": "x"}, {"date": "bad", "name": "B", "type": "x"}]))

    def refuse(self):
        raise AssertionError("counted")

    monkeypatch.setattr(DataFrame, "count", refuse)
    done = ingest_holidays(spark, [landed], "raw.never", mode="quarantine", dry_run=True)
    row = done.metrics.first()
    assert (row["status"], row["records_received"], row["records_loaded"]) == ("SUCCESS", 2, 1)
    empty = land(tmp_path / "in", "2025.json", "[]")
    row = ingest_holidays(spark, [empty], "raw.never", dry_run=True).metrics.first()
    assert (row["status"], row["records_received"], row["records_loaded"]) == ("SUCCESS", 0, 0)


def test_ensure_upsert_and_required(spark, tmp_path):
    table = "raw_db.holidays"
    for _ in range(2):
        tables.ensure_table(spark, table, location=str(tmp_path / "raw"))
    row = ("k", dt.date(2026, 1, 1), "n", "t", "s", NOW)
    batch = spark.createDataFrame([row], tables.RAW_HOLIDAYS)
    assert tables.upsert(batch.limit(0), table) == 0
    assert tables.upsert(batch, table) == 1
    later = batch.withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 1 hour"))
    assert tables.upsert(batch.unionByName(later).withColumn("source", F.lit("x")), table) == 1
    stored = tables.source(spark, table, ["source", "ingested_at", "year"]).first()
    assert tuple(stored) == ("x", NOW + dt.timedelta(hours=1), 2026)
    with pytest.raises(Exception, match="required column name is NULL"):
        tables.upsert(batch.withColumn("name", F.lit(None).cast("string")), table)
    assert tables.read_by_key(spark, table, "holiday_id", "k", ["holiday_id"]).count() == 1


def test_a_table_declared_over_existing_data_keeps_it(spark, tmp_path):
    place = str(tmp_path / "kept")
    first = ("k", dt.date(2026, 1, 1), "n", "t", "s", NOW)
    tables.ensure_table(spark, "kept_a", location=place)
    assert tables.upsert(spark.createDataFrame([first], tables.RAW_HOLIDAYS), "kept_a") == 1
    # Another catalog's view of the same folder, as after a restart.
    tables.ensure_table(spark, "kept_b", location=place)
    second = ("l", dt.date(2026, 5, 1), "n", "t", "s", NOW)
    assert tables.upsert(spark.createDataFrame([second], tables.RAW_HOLIDAYS), "kept_b") == 2


def test_read_by_key_reaches_the_scan(spark, tmp_path):
    tables.ensure_table(spark, "messages", "id string, message string", str(tmp_path / "m"), by_year_of=None)
    tables.append(spark.createDataFrame([("a", "x"), ("b", "y")], "id string, message string"), "messages")
    tables.append(spark.createDataFrame([("c", "z")], "id string, message string"), "messages")
    found = tables.read_by_key(spark, "messages", "id", "b", ["message"])
    assert [r[0] for r in found.collect()] == ["y"] and spark.table("messages").count() == 3
    assert "EqualTo(id,b)" in found._jdf.queryExecution().executedPlan().toString()


def test_sales_csv(spark, tmp_path):
    head = "sale_id,sale_date,product_id,product_category,quantity,unit_price,revenue,region\n"
    good = land(tmp_path / "csv", "a.csv", head + "S1,2024-02-05, P1 ,Bebidas,45,12.50,562.50,Sul \n")
    row = stg_sales(read_sales_csv(spark, good)).first()
    assert (row["sale_date"], row["product_id"], row["quantity"], row["revenue"], row["region"]) == (
        dt.date(2024, 2, 5), "P1", 45, Decimal("562.50"), "Sul",
    )
    bad = land(tmp_path / "csv", "b.csv", head + "S1,2024-02-05,P1,Bebidas,many,12.50,562.50,Sul\n")
    with pytest.raises(Exception):
        read_sales_csv(spark, bad).collect()


def test_fractional_quantities_round(spark):
    raw = spark.sql(
        "SELECT 's' sale_id, DATE'2024-01-01' sale_date, 'p' product_id, 'c' product_category, "
        "q quantity, 1.5 unit_price, 1.5 revenue, 'r' region FROM VALUES (2.5D), (-2.5D), (2.4D) t(q)"
    )
    assert sorted(r["quantity"] for r in stg_sales(raw).collect()) == [-3, 2, 3]


def test_ledger_import(spark, tmp_path):
    record = {"job_id": "j", "project_id": "p", "start_time": "2026-01-05T10:00:00+00:00", "bytes_billed": 5}
    good = land(tmp_path / "led", "good.json", json.dumps([record, record], indent=2))
    corrupt = land(tmp_path / "led", "bad.json", '[{"job_id": "j"}, {"job_id": "k"')
    read = ledger.read_json_ledger(spark, good)
    assert read.count() == 2 and read.first()["start_time"] == dt.datetime(2026, 1, 5, 10)
    assert [r.job_id for r in ledger.read_json_ledger(spark, corrupt).collect()] == ["j"]
    assert ledger.read_json_ledger(spark, str(tmp_path / "none.json")).count() == 0
    assert {r.reject_reason for r in ledger.ledger_rejects(spark, corrupt).collect()} == {"record: not an object"}
    lines = land(
        tmp_path / "led",
        "lines.json",
        '{"job_id": "a", "bytes_billed": 7.5}\n{"status": "SUCCESS", "bytes_billed": 100}\nnonsense\n[1]\n{"bytes_billed": "x", "job_id": "b"}\n',
    )
    kept = ledger.read_json_ledger(spark, lines, lines=True).collect()
    assert sorted((r.job_id or "", r.bytes_billed) for r in kept if r.bytes_billed) == [("", 100), ("a", 8)]
    assert len(kept) == 3
    reasons = sorted(r.reject_reason for r in ledger.ledger_rejects(spark, lines, lines=True).collect())
    assert reasons == ["bytes_billed: does not fit", "record: not an object", "record: not an object"]
    place = str(tmp_path / "parquet")
    assert ledger.read_ledger(spark, place).count() == 0
    ledger.append_ledger(read, place)
    ledger.append_ledger(read, place)
    assert ledger.read_ledger(spark, place).count() == 4


def parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parseJson")


def test_ledger_lines_are_parsed_once(spark, tmp_path):
    text = '{"job_id": "a", "status": "SUCCESS"}\n \n{"job_id": "b", "status": 5, "bytes_billed": "x"}\nnonsense\n[1]\n{}\n'
    lines = land(tmp_path / "led", "lines.json", text)
    read = ledger.read_json_ledger(spark, lines, lines=True)
    done = read.where("status = 'SUCCESS' AND start_time IS NULL")
    rejects = ledger.ledger_rejects(spark, lines, lines=True)
    assert [parses(df) for df in (read, done, rejects)] == [1, 1, 1]
    assert [r.job_id for r in done.collect()] == ["a"]
    assert sorted((r.job_id or "", r.status or "") for r in read.collect()) == [("", ""), ("a", "SUCCESS"), ("b", "5")]
    found = sorted((r.job_id or "", r.reject_reason) for r in rejects.collect())
    assert found == [("", "record: not an object")] * 2 + [("b", "bytes_billed: does not fit")]


def test_ledger_import_parses_no_record_for_an_append(spark, tmp_path, monkeypatch):
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    day = dt.datetime(1996, 2, 29)
    rows = [(i, i % 7, "FPO"[i % 3], 1e4 * i, day, None if i == 4 else "p") for i in range(30)] + [(5, 5, None, None, None, "p")]
    spark.createDataFrame(rows, orders).write.parquet(str(tmp_path / "orders.parquet"))
    appended, append = [], ledger.append_ledger

    def watched(records, path):
        appended.append((parses(records), records.count()))
        append(records, path)

    monkeypatch.setattr(ledger, "append_ledger", watched)
    found = registry.QUERIES["ledger_import"](spark, str(tmp_path))
    assert appended == [(0, 10), (0, 21)]
    assert sorted(int(r.job_id) for r in found.collect()) == sorted(r[0] for r in rows)
    first = found.where("job_id = '3'").first()
    assert (first.status, first.bytes_processed, first.bytes_billed, first.run_month) == ("SUCCESS", 3_000_000, 3 * 1048576, "1996-02")
    assert found.where("start_time IS NULL AND bytes_billed IS NULL AND run_month IS NULL").count() == 1
