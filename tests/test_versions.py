"""Versions of tables: what readers see when writers stop, and which parts a change touches."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.session import setting
from tidemark.sources import versions as v

SCHEMA = "id string, day date, name string"


def holidays(spark, rows):
    return spark.createDataFrame(rows, "id string, day string, name string, arrival long").withColumn("day", F.col("day").cast("date"))


def put(spark, root, rows):
    return v.upsert(holidays(spark, rows), root, "id", ["arrival"], F.year("day"), ("name",))


def seen(spark, root):
    return sorted(tuple(map(str, row)) for row in v.rows_of(spark, root, v.current(spark, root)).collect())


FIRST = [("a", "2024-01-01", "one", 1), ("b", "2025-01-01", "two", 1), ("c", "2025-06-01", "three", 1)]
SECOND = [("b", "2025-01-01", "TWO", 1), ("b", "2025-01-01", "Two", 2), ("d", "2026-01-01", "four", 1)]
OLD = [("a", "2024-01-01", "one"), ("b", "2025-01-01", "two"), ("c", "2025-06-01", "three")]
NEW = [("a", "2024-01-01", "one"), ("b", "2025-01-01", "Two"), ("c", "2025-06-01", "three"), ("d", "2026-01-01", "four")]


def test_upsert_touches_the_batch_parts_only(spark, tmp_path):
    root = str(tmp_path)
    first = put(spark, root, FIRST)
    second = put(spark, root, SECOND)
    assert seen(spark, root) == NEW
    assert [part for part in first.parts if part.key == "2024"] == [part for part in second.parts if part.key == "2024"]
    assert {part.key for part in second.parts} == {"2024", "2025", "2026"}
    # The old version is there until it expires.
    assert sorted(tuple(map(str, r)) for r in v.rows_of(spark, root, v.at_version(spark, root, 1)).collect()) == OLD
    assert put(spark, root, []).number == 2
    gone = v.expire(spark, root, keep=1)
    assert len(gone) == 1 and gone[0].endswith("_key=2025")
    assert seen(spark, root) == NEW


def test_files_are_skipped_by_their_zones(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"k{i:04d}", f"202{i % 3}-01-01", f"name{i % 40:02d}", 1) for i in range(1200)]
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"), setting(spark, "spark.sql.shuffle.partitions", "12"):
        put(spark, root, rows)
        put(spark, root, [("k0001", "2021-01-01", "name39", 2)])
    every = v.rows_of(spark, root, v.current(spark, root)).inputFiles()
    assert len(every) > 6
    by_name = v.files_with(spark, root, "name", "name07")
    assert 0 < len(by_name) <= len(every) // 2
    found = v.rows_with(spark, root, "name", "name07")
    short = lambda names: {name.rsplit(root, 1)[1] for name in names}
    assert short(found.inputFiles()) == short(by_name)
    assert sorted(r.id for r in found.collect()) == [f"k{i:04d}" for i in range(7, 1200, 40)]
    assert [tuple(map(str, r)) for r in v.rows_with(spark, root, "id", "k0001").collect()] == [("k0001", "2021-01-01", "name39")]
    assert v.files_with(spark, root, "id", "z") == []
    assert v.rows_with(spark, root, "id", "z").collect() == []


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["required", "latest_by", "materialise", "rows_of", "commit", "write_manifest", "publish"])
@pytest.mark.parametrize("after", [False, True])
def test_a_writer_that_stops_leaves_a_whole_table(spark, tmp_path, monkeypatch, step, after):
    root = str(tmp_path)
    put(spark, root, FIRST)
    whole = getattr(v, step)

    def stopping(*args, **kwargs):
        if after:
            whole(*args, **kwargs)
        raise Stop

    with monkeypatch.context() as patched:
        patched.setattr(v, step, stopping)
        with pytest.raises(Stop):
            put(spark, root, SECOND)
    published = after and step in ("publish", "commit")
    assert seen(spark, root) == (NEW if published else OLD)
    put(spark, root, SECOND)
    assert seen(spark, root) == NEW


def test_of_two_writers_one_wins(spark, tmp_path):
    root = str(tmp_path)
    first = put(spark, root, FIRST)
    put(spark, root, SECOND)
    with pytest.raises(v.VersionConflict):
        v.commit(spark, root, first, first.schema, [])
    assert seen(spark, root) == NEW


def records(r, n, start):
    return [(r.choice(["p", "q", None, "hot", "hot"]), r.choice([None, *range(start, start + 50)]), f"j{r.randrange(30)}", i) for i in range(n)]


def expected(batches, rows):
    kept = {}
    for at, batch in enumerate(batches):
        for record in batch:
            kept.setdefault(record[0], []).append((record[1] is not None, record[1] or 0, record[2], at, record))
    return {group: sorted(found, key=lambda x: x[:4])[-rows:] for group, found in kept.items()}


def test_append_keeps_the_newest(spark, tmp_path):
    root, r = str(tmp_path), random.Random(2)
    batches = [records(r, 40, 10 * k) for k in range(3)] + [[], records(r, 200, 25), [("new", 1, "j", 0)] * 30]
    for k, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "project string, at long, job string, i long").repartition(3)
        v.append_newest(df, root, "project", ["at", "job"], rows=20)
        found = v.newest_rows(spark, root).collect()
        for group, kept in expected(batches[: k + 1], 20).items():
            own = [row for row in found if row.project == group]
            # Rows that tie in time, job and batch may stand for each other.
            assert sorted((row.at is not None, row.at or 0, row.job) for row in own) == sorted(x[:3] for x in kept)


def test_append_writes_only_parts_that_lose_rows(spark, tmp_path):
    root = str(tmp_path)

    def add(project, times):
        df = spark.createDataFrame([(project, t) for t in times], "project string, at long")
        return v.append_newest(df, root, "project", ["at"], rows=10)

    one = add("p", range(8)).parts
    two = add("q", range(5)).parts
    assert two[0] == one[0]
    three = add("p", range(100, 102)).parts
    # Ten rows of p: nothing is lost.
    assert three[:2] == two
    four = add("p", range(200, 205)).parts
    # The five oldest of p go: the first part is written anew, those of q and of the third append stay.
    assert one[0] not in four and two[1] in four and three[2] in four
    assert sorted(row["at"] for row in v.newest_rows(spark, root).where("project = 'p'").collect()) == [5, 6, 7, 100, 101, *range(200, 205)]
    five = add("p", [-5]).parts
    # A row that is too old goes at once, and no other part is touched.
    assert all(part in five for part in four)
    assert v.newest_rows(spark, root).count() == 15
