import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.budget import Budget
from tidemark.plans import calendar, opportunities, quality, sales, usage
from tidemark.plans.models import build_models
from tidemark.session import materialise

HOLIDAYS = "holiday_id string, holiday_date date, holiday_name string, holiday_type string"


def d(text):
    return dt.date.fromisoformat(text)


def holidays(spark, *rows):
    return spark.createDataFrame([(f"h{i}", d(day), name, "national") for i, (day, name) in enumerate(rows)], HOLIDAYS)


def by_day(df, column="calendar_date"):
    found = {}
    for row in df.collect():
        found.setdefault(row[column], []).append(row)
    return found


def test_default_spine(spark):
    spine = calendar.date_spine(spark)
    assert spine.count() == 1096
    assert spine.agg(F.min("calendar_date"), F.max("calendar_date")).first()[:] == (d("2024-01-01"), d("2026-12-31"))
    assert calendar.date_spine(spark, d("2024-02-01"), d("2024-01-31")).count() == 0


def test_calendar_parts(spark):
    days = by_day(calendar.calendar_parts(calendar.date_spine(spark, d("2024-12-29"), d("2025-01-01"))))
    (sunday,), (monday,) = days[d("2024-12-29")], days[d("2024-12-30")]
    assert (sunday.day_of_week_num, sunday.day_of_week_name, sunday.week_of_year, sunday.is_weekend) == (1, "Sunday", 52, True)
    assert (monday.week_of_year, monday.month_name, monday.quarter_number, monday.is_weekend) == (1, "December", 4, False)


def test_windows_around_holidays(spark):
    table = holidays(spark, ("2024-12-25", "Natal"), ("2024-12-28", "Sábado"), ("2026-01-01", "Ano"))
    days = by_day(calendar.commercial_calendar(spark, table, d("2024-12-01"), d("2025-01-05")))
    assert len(days) == 36 and all(len(rows) == 1 for rows in days.values())

    def look(day):
        (row,) = days[d(day)]
        return (row.is_holiday, row.holiday_name, row.days_to_holiday, row.days_after_holiday,
                row.is_pre_holiday_window, row.is_post_holiday_window, row.is_business_day)

    assert look("2024-12-17") == (False, "Dia Comum", 8, None, False, False, True)
    assert look("2024-12-18") == (False, "Dia Comum", 7, None, True, False, True)
    # A holiday is in neither window, even with another one three days away.
    assert look("2024-12-25") == (True, "Natal", 0, 0, False, False, False)
    assert look("2024-12-26") == (False, "Dia Comum", 2, 1, True, True, True)
    assert look("2024-12-28")[0] and look("2024-12-28")[6] is False
    assert look("2024-12-31") == (False, "Dia Comum", 366, 3, False, True, True)
    assert look("2025-01-01") == (False, "Dia Comum", 365, 4, False, False, True)


def test_days_after_the_last_holiday_and_no_holidays_at_all(spark):
    for table in (holidays(spark, ("2024-01-01", "Ano")), holidays(spark).limit(0)):
        rows = calendar.commercial_calendar(spark, table, d("2024-02-01"), d("2024-02-03")).collect()
        assert len(rows) == 3
        for row in rows:
            assert row.next_holiday_date is None and row.days_to_holiday is None
            assert row.is_pre_holiday_window is False and row.is_post_holiday_window is False


def test_two_holidays_on_a_date(spark):
    table = holidays(spark, ("2024-12-25", "Natal"), ("2024-12-25", "Cidade"))
    span = d("2024-12-24"), d("2024-12-26")
    every = by_day(calendar.commercial_calendar(spark, table, *span))
    assert [len(every[day]) for day in sorted(every)] == [1, 2, 1]
    first = by_day(calendar.commercial_calendar(spark, table, *span, on_duplicate_date="first"))
    assert [r.holiday_name for r in first[d("2024-12-25")]] == ["Natal"]
    with pytest.raises(ValueError):
        calendar.commercial_calendar(spark, table, *span, on_duplicate_date="any")


def raw_sales(spark, rows):
    filled = [(i, day, "p", category, 1, revenue, revenue, "Sul") for i, day, category, revenue in rows]
    return spark.createDataFrame(
        filled,
        "sale_id string, sale_date string, product_id string, product_category string, quantity int, "
        "unit_price double, revenue double, region string",
    )


def raw_holidays(spark, *rows):
    return spark.createDataFrame(
        [(f"h{i}", day, name, "National", "s", "2026-01-01 00:00:00") for i, (day, name) in enumerate(rows)],
        "holiday_id string, date string, name string, type string, source string, ingested_at string",
    )


SALES = [
    ("s1", "2024-03-01", "A", 100.0),
    ("s2", "2024-03-04", "A", 200.0),
    ("s3", "2024-12-24", "A", 195.0),
    ("s4", "2024-12-23", "A", 195.0),
    ("s5", "2024-12-25", "A", 999.0),
    ("s6", "2024-12-27", "A", 50.0),
    ("s7", "2024-12-22", "B", 10.0),
    ("s8", "2023-12-22", "B", 10.0),
]


def test_models_end_to_end(spark):
    models = build_models(raw_holidays(spark, ("2024-12-25", " Natal ")), raw_sales(spark, SALES))
    facts = {r.sale_id: r.sales_period_context for r in models["fct_sales"].collect()}
    assert facts == {
        "s1": "DIA_COMUM", "s2": "DIA_COMUM", "s3": "PRE_FERIADO", "s4": "PRE_FERIADO",
        "s5": "DURANTE_FERIADO", "s6": "POS_FERIADO", "s7": "PRE_FERIADO",
    }
    assert len(models["fct_sales"].columns) == 20 and len(models["dim_calendar"].columns) == 18
    assert len(models["commercial_calendar"].columns) == 20
    mart = {r.product_category: r for r in models["mart_opportunities"].collect()}
    a, b = mart["A"], mart["B"]
    assert (a.holiday_name, a.avg_sales_normal, a.avg_sales_before_holiday) == ("Natal", Decimal("150.00"), Decimal("195.00"))
    assert (a.total_revenue_pre_holiday, a.total_transactions_pre_holiday) == (Decimal("390.00"), 2)
    assert (a.sales_growth_pct, a.opportunity_score) == (Decimal("30.00"), "ALTA")
    assert a.recommendation == "Oportunidade ALTA para A: Antecipar campanhas promocionais em D-7 e reforçar estoque."
    # No ordinary day for B: no baseline, no growth.
    assert (b.avg_sales_normal, b.sales_growth_pct, b.opportunity_score) == (0, 0, "BAIXA")
    report = quality.data_quality_report(models)
    assert report.count() == 36 and report.where("status = 'fail'").count() == 0
    outside = sales.sales_outside_calendar(models["stg_sales"], models["dim_calendar"])
    assert [r.sale_id for r in outside.collect()] == ["s8"]
    counts = {r.sales_period_context: r.n_sales for r in sales.sales_by_context(models["stg_sales"], models["dim_calendar"]).collect()}
    assert counts == {"DIA_COMUM": 2, "PRE_FERIADO": 3, "DURANTE_FERIADO": 1, "POS_FERIADO": 1}
    assert opportunities.mart_opportunities_as_written(models["fct_sales"]).count() == 0


def test_one_pass_mart_equals_the_two_sided_form(spark):
    models = build_models(raw_holidays(spark, ("2024-12-25", "Natal"), ("2024-03-08", "X")), raw_sales(spark, SALES))
    facts = models["fct_sales"]
    named = opportunities.with_next_holiday(facts, models["stg_holidays"])
    sides = opportunities.pre_holiday_sales(named).join(opportunities.baseline_sales(facts), "product_category", "left")
    expected = {
        (r.holiday_name, r.product_category, r.avg_revenue_normal or 0, r.avg_revenue_before_holiday,
         r.total_revenue_pre_holiday, r.total_transactions_pre_holiday)
        for r in sides.collect()
    }
    assert {tuple(r)[:6] for r in models["mart_opportunities"].collect()} == expected


@pytest.mark.parametrize("pct, score, word", [(29.99, "MEDIA", "MÉDIA"), (30.0, "ALTA", "ALTA"), (15.0, "MEDIA", "MÉDIA"), (14.99, "BAIXA", "regular")])
def test_score_thresholds(spark, pct, score, word):
    base = 10000.0
    rows = [("n", "2024-03-01", "A", base), ("p", "2024-12-24", "A", base * (1 + pct / 100))]
    mart = build_models(raw_holidays(spark, ("2024-12-25", "Natal")), raw_sales(spark, rows))["mart_opportunities"]
    (row,) = mart.collect()
    assert row.opportunity_score == score and word in row.recommendation


def test_duplicate_dates_show_up_in_the_report(spark):
    models = build_models(
        raw_holidays(spark, ("2024-12-25", "Natal"), ("2024-12-25", "Cidade")), raw_sales(spark, SALES)
    )
    failed = {(r.relation, r.test, r.column_name) for r in quality.data_quality_report(models).where("status = 'fail'").collect()}
    assert failed == {
        ("commercial_calendar", "unique", "calendar_date"),
        ("dim_calendar", "unique", "date"),
        ("fct_sales", "unique", "sale_id"),
    }


def test_next_holiday_goes_by_the_smallest_name(spark):
    names = opportunities.next_holiday_names(holidays(spark, ("2024-12-25", "Natal"), ("2024-12-25", "Cidade")))
    assert [tuple(r) for r in names.collect()] == [(d("2024-12-25"), "Cidade")]


def test_facts_join_without_shuffling_the_sales(spark):
    dim = calendar.dim_calendar(calendar.commercial_calendar(spark, holidays(spark, ("2024-12-25", "Natal"))))
    dim = materialise(dim, "dim_calendar")
    from tidemark.plans.staging import stg_sales

    plan = sales.fct_sales(stg_sales(raw_sales(spark, SALES)), dim)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


JOBS = "project_id string, start_time timestamp, bytes_billed long, status string, state string"


def test_monthly_usage_counts_failed_jobs_unless_asked_not_to(spark):
    start = dt.datetime(2026, 1, 31, 23, 59)
    jobs = spark.createDataFrame(
        [("p", start, 10, "SUCCESS", "DONE"), ("p", start, 5, "ERROR", "DONE"), ("p", start, None, "SUCCESS", "DONE"),
         ("p", start, 7, "SUCCESS", "RUNNING"), ("p", start + dt.timedelta(minutes=1), 1, "SUCCESS", "DONE")],
        JOBS,
    )
    january = d("2026-01-01")
    listed = {r.month: r.bytes_used_month for r in usage.monthly_usage(usage.billed_jobs(jobs)).collect()}
    assert listed == {january: 15, d("2026-02-01"): 1}
    recorded = {r.month: r.bytes_used_month for r in usage.monthly_usage(jobs, "SUCCESS").collect()}
    assert recorded[january] == 17
    current = usage.usage_of_month(usage.successful_records(jobs), dt.datetime(2026, 1, 5)).collect()
    assert [tuple(r) for r in current] == [("p", january, 17)]
    projects = spark.createDataFrame([("p",), ("idle",)], "project_id string")
    known = usage.usage_of_month(usage.successful_records(jobs), dt.datetime(2026, 1, 5), projects=projects).collect()
    assert sorted(tuple(r) for r in known) == [("idle", january, 0), ("p", january, 17)]


def test_usage_summary_figures(spark):
    gib = 1024**3
    used = spark.createDataFrame([("p", d("2026-01-01"), 512 * gib), ("q", d("2026-01-01"), 10485760)], "project_id string, month date, bytes_used_month long")
    rows = {r.project_id: r for r in usage.usage_summary(used, Budget()).collect()}
    p, q = rows["p"], rows["q"]
    assert len(p) == 13 and p.month == "2026-01"
    assert (p.pct_free_tier_used, p.pct_free_tier_remaining, p.pct_ceiling_used) == (50.0, 50.0, 100.0)
    assert (p.alert_level, p.circuit_breaker_active, p.bytes_remaining_to_ceiling) == ("BLOQUEIO_OPERACIONAL", True, 0)
    assert (q.gib_used_month, q.gib_remaining_to_ceiling, q.operational_ceiling_gib) == (0.01, 511.99, 512.0)
    assert (q.free_tier_total_gib, q.alert_level, q.circuit_breaker_active) == (1024.0, "NORMAL", False)


def test_restricted_projects(spark):
    jobs = spark.createDataFrame([("my-ACME-x",), ("own",)], "project_id string")
    assert [r[0] for r in usage.restricted_jobs(jobs, ["acme"]).collect()] == ["my-ACME-x"]
    assert usage.restricted_jobs(jobs, []).count() == 0
    with pytest.raises(Exception, match="restricted project my-ACME-x"):
        usage.require_unrestricted(jobs, ["acme"]).collect()


def test_request_verdicts(spark):
    requests = spark.createDataFrame(
        [("p", d("2026-01-01"), 600), ("q", d("2026-01-01"), 500), ("p", d("2026-02-01"), 101), ("p", d("2026-02-01"), 100)],
        "project_id string, month date, estimated_bytes long",
    )
    used = spark.createDataFrame([("p", d("2026-02-01"), 400)], "project_id string, month date, bytes_used_month long")

    def verdicts(budget):
        judged = usage.request_verdicts(requests, used, budget)
        return [r.verdict for r in judged.orderBy("month", "project_id", F.desc("estimated_bytes")).collect()]

    # The ceiling of 500 may be reached but not passed; a query's own size is tested first.
    assert verdicts(Budget(1000, 50.0)) == ["CIRCUIT_BREAKER", "ADMITTED", "CIRCUIT_BREAKER", "ADMITTED"]
    assert verdicts(Budget(1000, 50.0, 200)) == ["TOO_LARGE", "TOO_LARGE", "CIRCUIT_BREAKER", "ADMITTED"]


def test_from_landed_files_to_the_report(spark, tmp_path):
    import json

    from tidemark.plans.ingest import ingest_holidays
    from tidemark.sources.payloads import year_paths
    from tidemark.sources.sales import read_sales_csv

    (tmp_path / "2024.json").write_text(
        json.dumps([{"date": "2024-12-25", "name": "Natal", "type": "national"}]), encoding="utf-8"
    )
    lines = [f"{i},{day},p,{category},1,{revenue},{revenue},Sul" for i, day, category, revenue in SALES]
    head = "sale_id,sale_date,product_id,product_category,quantity,unit_price,revenue,region"
    (tmp_path / "sales.csv").write_text("\n".join([head, *lines]), encoding="utf-8")
    done = ingest_holidays(spark, year_paths(str(tmp_path), [2024]), "landed.holidays", location=str(tmp_path / "raw"))
    assert done.metrics.first().records_loaded == 1
    for _ in range(2):
        models = build_models(
            spark.table("landed.holidays"),
            read_sales_csv(spark, str(tmp_path / "sales.csv")),
            location=str(tmp_path / "models"),
        )
    assert models["mart_opportunities"].count() == 2
    assert quality.data_quality_report(models).where("status = 'fail'").count() == 0
