"""Tables in versions: readers see the last one that is whole.

A table is a folder.  Its rows lie in *parts*, folders that are written once and never changed;
a *manifest* lists the parts of a version.  A change writes new parts, then a new manifest
under a name of its own, and last gives that its number by a rename, which either happens
or does not and fails where another writer was first.  Readers take the manifest of the
largest number.  Whatever stops a writer, readers have the old table or the new one.

Parts that no kept version lists are deleted by ``expire``, not by the writers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_by
from tidemark.operators.retention import KEPT_RECORDS, keep_last
from tidemark.session import materialise
from tidemark.sources.tables import required


class VersionConflict(RuntimeError):
    """Another writer has published the version meanwhile; the change is to be made anew."""


@dataclass(frozen=True)
class Part:
    """A folder of rows; ``key`` says which rows it holds, where the table is divided by one."""

    path: str
    key: str | None = None


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    parts: list[Part] = field(default_factory=list)


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _numbers(spark: SparkSession, root: str) -> list[int]:
    system, path = _files(spark, root)
    found = system.globStatus(path(f"{root}/manifests/*.json")) or []
    return sorted(int(item.getPath().getName().split(".")[0]) for item in found)


def current(spark: SparkSession, root: str) -> Version | None:
    """The last version; None where there is none yet."""
    numbers = _numbers(spark, root)
    return at_version(spark, root, numbers[-1]) if numbers else None


def at_version(spark: SparkSession, root: str, number: int) -> Version:
    line = spark.read.text(f"{root}/manifests/{number:012d}.json", wholetext=True).first()["value"]
    given = json.loads(line)
    return Version(number, T.StructType.fromJson(given["schema"]), [Part(**part) for part in given["parts"]])


def rows_of(spark: SparkSession, root: str, version: Version | None, wanted: Callable[[Part], bool] = lambda part: True) -> DataFrame:
    """Rows of a version's parts; the others are not even listed."""
    paths = [f"{root}/{part.path}" for part in version.parts if wanted(part)]
    if not paths:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*paths)


def write_manifest(spark: SparkSession, root: str, version: Version) -> str:
    """The manifest under a name that no reader looks at."""
    system, path = _files(spark, root)
    name = f"{root}/manifests/{uuid.uuid4().hex}.waiting"
    content = {"schema": version.schema.jsonValue(), "parts": [part.__dict__ for part in version.parts]}
    out = system.create(path(name), False)
    try:
        out.write(json.dumps(content).encode())
    finally:
        out.close()
    return name


def publish(spark: SparkSession, root: str, waiting: str, number: int) -> None:
    """Give the manifest its number, in one step, unless another writer has taken it."""
    _, path = _files(spark, root)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(root).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    source, target = (context.makeQualified(path(name)) for name in (waiting, f"{root}/manifests/{number:012d}.json"))
    try:
        context.rename(source, target, options)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            raise VersionConflict(f"version {number} of {root} was written by another") from error
        raise


def commit(spark: SparkSession, root: str, before: Version | None, schema: T.StructType, parts: list[Part]) -> Version:
    version = Version(before.number + 1 if before else 1, schema, parts)
    publish(spark, root, write_manifest(spark, root, version), version.number)
    return version


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete older manifests, then the parts that none of the last ``keep`` versions lists.

    To be called while no writer is at work, as the parts of a change that is not published yet are listed nowhere.
    """
    numbers = _numbers(spark, root)
    system, path = _files(spark, root)
    used = {part.path for number in numbers[-keep:] for part in at_version(spark, root, number).parts}
    used_folders = {name.split("/")[1] for name in used}
    for number in numbers[:-keep]:
        system.delete(path(f"{root}/manifests/{number:012d}.json"), False)
    gone = []
    for item in system.globStatus(path(f"{root}/data/*")) or []:
        name = item.getPath().getName()
        if name not in used_folders:
            system.delete(item.getPath(), True)
            system.delete(path(f"{root}/zones/{name}"), True)
            gone.append(name)
            continue
        for inner in system.globStatus(path(f"{root}/data/{name}/_key=*")) or []:
            if f"data/{name}/{inner.getPath().getName()}" not in used:
                system.delete(inner.getPath(), True)
                gone.append(f"{name}/{inner.getPath().getName()}")
    return gone


# ---------------------------------------------------------------- keyed upsert


def upsert(batch: DataFrame, root: str, key: str, arrival: list[str], part_by: Column, clustering: tuple[str, ...] = ()) -> Version | None:
    """Overlay ``batch`` on the table by key, in one step for its readers; the new version.

    ``part_by`` divides the table (by year, say) and must follow from the key: only the parts
    that the batch touches are read and written anew.  The last row of a key by ``arrival``
    counts; arrival columns that are not in the table are dropped.  An empty batch changes nothing.
    """
    spark = batch.sparkSession
    before = current(spark, root)
    stored = before.schema.names if before else [c for c in batch.columns if c not in arrival]
    order = [f"_arrival_{i}" for i in range(len(arrival))]
    given = required(batch.select(*stored, *(F.col(a).alias(o) for a, o in zip(arrival, order))), stored)
    newest = latest_by(given, [key], [F.desc(name) for name in order]).drop(*order)
    new = materialise(newest.withColumn("_key", part_by.cast("string")), "batch")
    # One name per part that the batch touches reaches the driver.
    touched = sorted(row["_key"] for row in new.select("_key").distinct().collect())
    if not touched:
        return before
    merged = new
    if before:
        old = rows_of(spark, root, before, lambda part: part.key in touched)
        merged = old.join(new.select(key), key, "left_anti").withColumn("_key", part_by.cast("string")).unionByName(new)
    folder = f"data/{uuid.uuid4().hex}"
    # By ranges, so that a part of many rows has many files, each of a range of its own.
    order = ["_key", *clustering, key]
    ranged = merged.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.partitionBy("_key").parquet(f"{root}/{folder}")
    _write_zones(spark, root, folder, [*clustering, key])
    kept = [part for part in before.parts if part.key not in touched] if before else []
    parts = kept + [Part(f"{folder}/_key={name}", name) for name in touched]
    return commit(spark, root, before, before.schema if before else new.drop("_key").schema, parts)


# ---------------------------------------------------------------- zones


def _write_zones(spark: SparkSession, root: str, folder: str, columns: list[str]) -> None:
    """The least and largest value of each column in every file of a folder, in a table beside them."""
    of_file = F.col("_metadata.file_path").alias("_file")
    bounds = [(f, c, kind) for c in columns for f, kind in ((F.min, "low"), (F.max, "high"))]
    rows = spark.read.parquet(f"{root}/{folder}").select(of_file, F.col("_key").cast("string").alias("_of_key"), *columns)
    zones = rows.groupBy("_file", "_of_key").agg(*(f(c).alias(f"{kind}_{c}") for f, c, kind in bounds))
    zones.write.parquet(f"{root}/zones/{folder.split('/')[1]}")


def files_with(spark: SparkSession, root: str, column: str, value) -> list[str]:
    """Files of the current version that can hold ``value`` in a clustering column or the key."""
    version = current(spark, root)
    folders: dict[str, list[str]] = {}
    for part in version.parts if version else []:
        folders.setdefault(part.path.split("/")[1], []).append(part.key)
    if not folders:
        return []
    current_keys = F.lit(False)
    zones = spark.read.option("basePath", f"{root}/zones").parquet(*(f"{root}/zones/{folder}" for folder in folders))
    zones = zones.withColumn("_folder", F.element_at(F.split(F.regexp_extract("_metadata.file_path", r"zones/[^/]+", 0), "/"), 2))
    for folder, keys in folders.items():
        current_keys = current_keys | ((F.col("_folder") == folder) & F.col("_of_key").isin(keys))
    wanted = zones.where(current_keys).where(F.lit(value).between(F.col(f"low_{column}"), F.col(f"high_{column}")))
    # One name per file that has to be read anyway.
    return sorted(unquote(row["_file"]) for row in wanted.select("_file").collect())


def rows_with(spark: SparkSession, root: str, column: str, value) -> DataFrame:
    """Rows of the current version with ``value`` in a clustering column or the key; other files are not opened."""
    version = current(spark, root)
    files = files_with(spark, root, column, value)
    if not files:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*files).where(F.col(column) == F.lit(value))


# ---------------------------------------------------------------- append that keeps the newest

#: Where a row came from: the version that added it, and its place there.
_ORIGIN = ("_version", "_row")


def _newness(newest: list[str]) -> Column:
    return F.struct(*newest, *_ORIGIN)


def append_newest(batch: DataFrame, root: str, group: str, newest: list[str], rows: int = KEPT_RECORDS) -> Version | None:
    """Append ``batch``; of each group the ``rows`` newest rows stay, by the columns ``newest``, nulls the oldest.

    Of rows that tie the later appended stays.  Beside its rows every part has a summary: per group
    the number of rows and its oldest.  Only groups that the batch makes too large are
    looked at, in the columns that order them, and only parts that lose rows are written anew.  A
    group's limit holds per task before the shuffle, so a large group costs few rows a task.
    """
    spark = batch.sparkSession
    before = current(spark, root)
    number = before.number + 1 if before else 1
    marked = batch.withColumn("_version", F.lit(number).cast("long")).withColumn("_row", F.monotonically_increasing_id())
    order = [F.desc(name) for name in (*newest, *_ORIGIN)]
    added = Part(f"data/{uuid.uuid4().hex}")
    schema = before.schema if before else marked.schema
    keep_last(marked, [group], order, rows).select(*schema.names).write.parquet(f"{root}/{added.path}/rows")
    _summarise(spark, root, added, schema, group, newest)

    parts = [*(before.parts if before else []), added]
    summary = _summary(spark, root, parts, group)
    full = summary.groupBy(group).agg(F.sum("n").alias("n")).where(F.col("n") > rows).select(F.col(group).alias("_full"))
    full = materialise(full, "full-groups")
    if not full.isEmpty():
        of_full = rows_of(spark, root, Version(number, schema, _rows(parts))).join(full, F.col(group).eqNullSafe(F.col("_full")), "left_semi")
        left = keep_last(of_full.select(group, *newest, *_ORIGIN), [group], order, rows)
        limit = left.groupBy(F.col(group).alias("_full")).agg(F.min(_newness(newest)).alias("_limit"))
        limit = materialise(limit, "limits")
        over = F.col(group).eqNullSafe(F.col("_full"))
        losing = summary.join(limit, over).where(F.col("oldest") < F.col("_limit")).select("part").distinct()
        # One name per part that loses rows.
        losing = {row["part"] for row in losing.collect()}
        cut = [part for part in parts if part.path in losing]
        if cut:
            rest = Part(f"data/{uuid.uuid4().hex}")
            old = rows_of(spark, root, Version(number, schema, _rows(cut))).join(limit, over, "left")
            kept = old.where(F.col("_limit").isNull() | (_newness(newest) >= F.col("_limit")))
            kept.select(*schema.names).write.parquet(f"{root}/{rest.path}/rows")
            _summarise(spark, root, rest, schema, group, newest)
            parts = [part for part in parts if part.path not in losing] + [rest]
    return commit(spark, root, before, schema, parts)


def newest_rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows that ``append_newest`` has kept."""
    version = current(spark, root)
    return rows_of(spark, root, Version(version.number, version.schema, _rows(version.parts))).drop(*_ORIGIN)


def _rows(parts: list[Part]) -> list[Part]:
    return [Part(f"{part.path}/rows") for part in parts]


def _summarise(spark: SparkSession, root: str, part: Part, schema: T.StructType, group: str, newest: list[str]) -> None:
    found = spark.read.schema(schema).parquet(f"{root}/{part.path}/rows")
    summary = found.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(_newness(newest)).alias("oldest"))
    summary.withColumn("part", F.lit(part.path)).write.parquet(f"{root}/{part.path}/summary")


def _summary(spark: SparkSession, root: str, parts: list[Part], group: str) -> DataFrame:
    return spark.read.parquet(*(f"{root}/{part.path}/summary" for part in parts))
