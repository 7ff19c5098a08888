"""Session settings and tables written between steps."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scratch: dict[str, set[str]] = {}


def local_session(cores: int | str = "*", app_name: str = "tidemark", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Instants are UTC everywhere, so months and days do not move with the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def with_package(spark: SparkSession) -> SparkSession:
    """Python workers look for this package where the driver has found it."""
    known = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[1])
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(part for part in (root, known.get("PYTHONPATH")) if part)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a ``with`` block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, in the cluster's shared checkpoint folder.

    A machine-local folder serves only a local master: on a cluster the files
    would vanish with the executor that wrote them.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def _on_file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, or a file that a glob names; asks its file system, lists no folder."""
    system, found = _on_file_system(spark, path)
    return bool(system.globStatus(found))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    system, found = _on_file_system(spark, path)
    system.delete(found, True)
    _scratch.get(spark.sparkContext.applicationId, set()).discard(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables that this application has written.

    Results that are still to be computed may read them, so it is the caller who
    knows when: after the last result is written.
    """
    for path in list(_scratch.get(spark.sparkContext.applicationId, ())):
        remove_path(spark, path)


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet once and read it back.

    For results used several times: the lineage ends here, lost executors cost
    a re-read, and Catalyst knows the size of what it scans.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
