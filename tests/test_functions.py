import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.budget import GIB, Budget, alert_level, cost_usd, in_unit
from tidemark.functions.dates import iso_date, run_label, seconds_between
from tidemark.functions.rounding import rounded
from tidemark.functions.keys import holiday_key
from tidemark.functions.money import growth_pct, mean_money
from tidemark.functions.text import SEPARATORS, WHITESPACE, blank, stripped, trimmed


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_trim_takes_every_unicode_blank(spark):
    padded = spark.createDataFrame([(WHITESPACE + "a b" + WHITESPACE,)], "t string")
    assert padded.select(trimmed(F.col("t"))).first()[0] == "a b"
    assert all(c.isspace() for c in WHITESPACE + SEPARATORS)


def test_strip_agrees_with_python_strip(spark):
    texts = ["x ", " x", "x\u00a0", "\u00e9 ", " \u00e9", "~", "~ ", "\x7f", "!\t!", "x\u2003\x1f", "", "x"]
    texts += [SEPARATORS + " x ", "\u200bx", "\ufeffx ", "\u3000", "\u00a0\u2028"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", stripped(F.col("t")).alias("s"), trimmed(F.col("t")).alias("w"), blank(F.col("t")).alias("b")
    )
    for row in rows.collect():
        assert row["s"] == row["t"].strip()
        assert row["w"] == row["t"].strip(WHITESPACE)
        assert row["b"] == (not row["t"].strip())


@pytest.mark.parametrize(
    "text",
    [
        "2026-01-05", "20260105", "2026-W01-1", "2026W011", "2026-W01", "2026W01", "2026-W53-7",
        "2025-W53-1", "2026-W00-1", "2026-W01-0", "2026-W01-8", "2026-02-30", "2024-02-29", "2026-1-5",
        "01/01/2026", "0000-01-01", "0001-01-01", "0001-W01-1", "9999-12-31", "2026-01-05\n", " 2026-01-05",
        "2026-01-05T00:00", "", "2026-13-01", "20260230", "2026-W1-1", "2026W01-1",
    ],
)
def test_lenient_dates_agree_with_python(spark, text):
    try:
        expected = dt.date.fromisoformat(text)
    except ValueError:
        expected = None
    assert value(spark, iso_date(F.lit(text), lenient=True)) == expected
    strict = expected if len(text) == 10 and text[4] == "-" and text[5] != "W" else None
    assert value(spark, iso_date(F.lit(text))) == strict


def test_key_is_the_hash_of_the_lowered_parts(spark):
    key = holiday_key(F.lit("2026-04-21"), F.lit("Tiradentes"), F.lit("NATIONAL"))
    assert value(spark, key) == "b043493920ba2dd72426919eada1fdf702c34648be64c8a16d2a692c17d02bfe"


@pytest.mark.parametrize(
    "used, level",
    [
        (50, "NORMAL"),
        (100, "ACOMPANHAMENTO"),
        (200, "ACOMPANHAMENTO"),
        (250, "ALERTA"),
        (350, "ALERTA"),
        (400, "ALERTA_CRITICO"),
        (499, "ALERTA_CRITICO"),
        (500, "BLOQUEIO_OPERACIONAL"),
        (600, "BLOQUEIO_OPERACIONAL"),
    ],
)
def test_alert_tiers(spark, used, level):
    assert value(spark, alert_level(F.lit(used), Budget(1000, 50.0))) == level


def test_a_low_operational_limit_hides_the_tiers_above_it(spark):
    budget = Budget(1000, 20.0)
    assert value(spark, alert_level(F.lit(150), budget)) == "ACOMPANHAMENTO"
    assert value(spark, alert_level(F.lit(250), budget)) == "BLOQUEIO_OPERACIONAL"


def test_budget_defaults_replace_missing_and_zero_limits():
    assert Budget(0, None, 0) == Budget()
    assert Budget().ceiling_bytes == 512 * GIB
    assert Budget(999, 33.3).ceiling_bytes == int(999 * (33.3 / 100.0))


def test_sample_job_cost(spark):
    assert value(spark, cost_usd(F.lit(10485760), Budget())) == 0.0001
    assert value(spark, in_unit(F.lit(10485760), GIB, 3)) == round(10485760 / GIB, 3)
    assert value(spark, in_unit(F.lit(GIB // 16), GIB, 3)) == round(0.0625, 3)


def test_money_rounds_half_away_from_zero(spark):
    rows = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "v decimal(18,2)")
    assert rows.agg(mean_money(F.col("v"))).first()[0] == Decimal("0.02")
    assert rows.agg(mean_money(-F.col("v"))).first()[0] == Decimal("-0.02")


@pytest.mark.parametrize(
    "after, base, pct",
    [("130.00", "100.00", "30.00"), ("2.00", "3.00", "-33.33"), ("5.00", "0.00", "0.00"), ("5.00", None, "0.00")],
)
def test_growth(spark, after, base, pct):
    def money(text):
        return F.lit(text).cast("decimal(18,2)")

    assert value(spark, growth_pct(money(after), money(base))) == Decimal(pct)


def test_run_label_and_duration(spark):
    start = F.lit("2026-01-05 13:45:00").cast("timestamp")
    end = F.lit("2026-01-05 13:45:02.346").cast("timestamp")
    assert value(spark, run_label(start)) == "20260105_134500"
    assert value(spark, seconds_between(start, end)) == 2.35


def test_rounding_is_that_of_the_exact_double(spark):
    r = random.Random(11)
    values = [2.345, 1.005, 0.285, 5e-5, 0.125, 2.5, -2.5, -2.345, 0.0, 1e15 + 0.5, 123456789.12345, 1e300]
    values += [r.uniform(-1e6, 1e6) for _ in range(500)] + [r.randrange(10**6) / 1000 for _ in range(500)]
    values += [r.randrange(-(10**6), 10**6) / 2**k for k in range(1, 20) for _ in range(10)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for decimals in (0, 1, 2, 3, 4):
        found = df.select("v", rounded(F.col("v"), decimals).alias("r")).collect()
        assert [row.r for row in found] == [round(row.v, decimals) for row in found]


def test_duration_at_a_binary_tie(spark):
    start = dt.datetime(2026, 1, 5, 12)
    assert value(spark, seconds_between(F.lit(start), F.lit(start + dt.timedelta(seconds=2, microseconds=345000)))) == 2.35
