import uuid
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import overlay
from tidemark.session import clear_scratch, materialise, path_exists, scratch_path, setting
from tidemark.sources import tables


def test_scratch_lies_in_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second
    table = materialise(spark.range(3), "three")
    assert table.count() == 3 and root in table.inputFiles()[0]


def test_a_cluster_without_a_shared_folder_is_refused():
    def session(master):
        context = SimpleNamespace(master=master, applicationId=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host:7077"), "x")
    assert scratch_path(session("local[2]"), "x")


def test_setting_is_restored(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    with setting(spark, key, "dynamic"):
        assert spark.conf.get(key).lower() == "dynamic"
    assert spark.conf.get(key) == before


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "none"))


def test_scratch_tables_go_when_told(spark, tmp_path):
    before = path_exists(spark, scratch_path(spark, "never-written"))
    table = materialise(spark.range(3), "short-lived")
    (place,) = {name.rsplit("/", 1)[0] for name in table.inputFiles()}
    assert not before and path_exists(spark, place) and path_exists(spark, place + "/part-*")
    clear_scratch(spark)
    assert not path_exists(spark, place)


def test_upsert_leaves_no_scratch_and_does_not_shuffle_existing_rows(spark, tmp_path):
    name = "upserted_" + uuid.uuid4().hex
    tables.ensure_table(spark, name, location=str(tmp_path / "t"))
    rows = spark.range(200).select(
        F.concat(F.lit("h"), "id").alias("holiday_id"),
        F.make_date(F.lit(2020) + (F.col("id") % 3).cast("int"), F.lit(1), F.lit(2)).alias("date"),
        F.lit("n").alias("name"),
        F.lit("t").alias("type"),
        F.lit("s").alias("source"),
        F.current_timestamp().alias("ingested_at"),
    )
    clear_scratch(spark)
    assert tables.upsert(rows, name) == 200
    assert tables.upsert(rows.limit(7).withColumn("name", F.lit("new")), name) == 200
    assert spark.table(name).where("name = 'new'").count() == 7
    assert not [p for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir() if p.name.startswith(("batch", "merged"))]
    small = materialise(rows.limit(7), "batch")
    plan = overlay(spark.table(name).drop("year"), small, ["holiday_id"], ["ingested_at"])._jdf.queryExecution().executedPlan().toString()
    existing = plan.index("LeftAnti")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan[existing : plan.index("BroadcastExchange")]
