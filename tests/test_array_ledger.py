"""Ledgers of array files: their size, reading by ranges, and what a broken element costs."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.session import setting
from tidemark.sources import ledger
from tidemark.sources.json_arrays import Change, array_elements, tokens
from workload.registry import _write_arrays


def _record(i, **more):
    return json.dumps({"job_id": str(i), "project_id": "p", "status": "SUCCESS", "bytes_billed": i} | more)


def small_splits(spark, size):
    return setting(spark, "spark.sql.files.maxPartitionBytes", str(size)), setting(spark, "spark.sql.files.openCostInBytes", "0")


def read(spark, path, size=1 << 27):
    first, second = small_splits(spark, size)
    with first, second:
        rows = ledger.ledger_items(spark, str(path)).collect()
    return sorted(r.job_id for r in rows if r.job_id is not None), sum(r.reject_reason is not None for r in rows), len(rows)


def test_a_month_has_as_many_files_as_its_records_fill(spark, tmp_path):
    rows = [(f"2024-0{1 + (i % 3 == 0)}-01", i, _record(i)) for i in range(300)]
    landed = str(tmp_path / "arrays")
    _write_arrays(spark.createDataFrame(rows, "month string, number long, value string").repartition(2), landed, per_file=50)
    files = spark.read.text(f"{landed}/*/*", wholetext=True).collect()
    sizes = [len(json.loads(row.value)) for row in files]
    # Four files of the month of 200 records, two of that of 100.
    assert sum(sizes) == 300 and len(sizes) == 6 and max(sizes) <= 75
    found = ledger.read_json_ledger(spark, f"{landed}/*/*")
    assert sorted(int(r.job_id) for r in found.collect()) == list(range(300))


#: What is no object stands with the element before it, and where both cannot be read that goes too.
ALONE = ['{"job_id": 13', '{"job_id": "13", "x": }', '{"a": {"b": 1}', '{"a": [1, 2}]', "17", '"},{"']
JOINED = ["nonsense", "}", ""]


@pytest.mark.parametrize("size", [200, 1 << 27])
def test_a_broken_element_costs_itself(spark, tmp_path, size):
    expected = []
    for k, broken in enumerate(ALONE + JOINED):
        good = [_record(100 * k + i) for i in range(10)]
        (tmp_path / f"{k}.json").write_text("[" + ",\n".join([*good[:5], broken, *good[5:]]) + "]")
        expected += [str(100 * k + i) for i in range(10) if i != 4 or broken in ALONE]
    found, rejects, _ = read(spark, tmp_path, size)
    assert found == sorted(expected)
    assert rejects == len(ALONE + JOINED)


ODD = [
    {"text": 'a "quoted" }, { text', "deep": [{"x": [1, {"y": "]}"}]}, {"x": 2}]},
    {"text": "back\\", "deep": {"a": {"b": [[], [{}], {}]}}},
    {"text": "},{\n\"[", "deep": []},
    {"text": "\\\"},{\\", "deep": [[{"a": 1}, {"b": 2}]]},
]


@pytest.mark.parametrize("size, indent", [(23, None), (150, None), (70, 2), (1 << 27, 2)])
def test_ranges_of_any_size_read_the_same(spark, tmp_path, size, indent):
    r = random.Random(size)
    records = [json.loads(_record(i)) | r.choice(ODD) for i in range(12)]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=indent) + r.choice(["", "\n", "  \n"]))
    (tmp_path / "b.json").write_text(" \n" + json.dumps([*records[:3], 5, None, "x", [1], {}], indent=indent))
    found, rejects, n = read(spark, tmp_path, size)
    assert found == sorted([str(i) for i in range(12)] + ["0", "1", "2"])
    assert (rejects, n) == (4, 20)


def test_files_that_are_no_arrays(spark, tmp_path):
    texts = {
        "object.json": _record(1) * 5,
        "empty.json": "",
        "none.json": "[]",
        "blank.json": " [ \n ] ",
        "open.json": "[" + _record(2) + ", " + _record(3),
        "cut.json": "[" + _record(4) + ", " + _record(5)[:-1],
        "after.json": "[" + _record(6) + "] " + _record(7),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    for size in (90, 1 << 27):
        found, rejects, _ = read(spark, tmp_path, size)
        assert found == ["2", "3", "4", "6"]
        # The object, the end that is open, the record that is cut and its array's end, what follows an array.
        assert rejects == 5


def test_packed_file(spark, tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as out:
        out.write("[" + ",".join(_record(i) for i in range(10, 60)) + "]\n")
    assert read(spark, tmp_path, 100) == ([str(i) for i in range(10, 60)], 0, 50)


def test_one_file_uses_many_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text("[" + ",".join(_record(i) for i in range(1000)) + "]")
    first, second = small_splits(spark, 5000)
    with first, second:
        text = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert text.rdd.getNumPartitions() > 10
        assert text.groupBy(F.spark_partition_id()).count().count() > 10
        assert array_elements(spark, str(tmp_path)).count() == 1000


def test_changes_compose():
    """The change of a text is that of its parts one after the other."""
    r = random.Random(7)
    for _ in range(300):
        text = "".join(r.choice(['"', "\\", "[", "]", "{", ",", "\n", "a"]) for _ in range(r.randrange(60))) + "}"
        cuts = [i + 1 for i, c in enumerate(text) if c == "}" or c == "a"]
        cut = r.choice(cuts)
        if text[:cut].endswith("\\a") or text[:cut].endswith("a"):
            continue
        for inside in (False, True):
            whole = Change(inside)
            whole.add(text)
            parts = Change(inside)
            parts.add(text[:cut])
            if text[cut:]:
                parts.add(text[cut:])
            assert (whole.in_string, whole.d, whole.m) == (parts.in_string, parts.d, parts.m)


def test_tokens_skip_strings():
    assert [kind for _, kind in tokens('{"a": "[,{"}, {"b": [1]}', False)] == [",", "[", "]"]
    assert [kind for _, kind in tokens('x\\"[", {"a": 1', True)] == [","]
    assert [kind for _, kind in tokens('"open', False)] == ['"']
