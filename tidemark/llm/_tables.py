"""Intermediate tables in the folder that driver and executors share: lineage ends at them, and they go when they are needed no more."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: what the session names; a local one only where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return "/tmp/tidemark-checkpoints"


#: Spark deletes an execution's shuffle files when it ends; else they stay until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, after: tuple = ()) -> DataFrame:
    """The rows, written as a table in the shared folder and read again: lineage ends here.

    after: stored tables that are needed no more once this one is written. What is left is removed at exit.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    if not _MADE:
        atexit.register(_remove)
    out = spark.read.schema(df.schema).parquet(path)
    _MADE[path] = spark
    out.stored_at = path
    free(*after)
    return out


def free(*tables: DataFrame) -> None:
    """Deletes stored tables, of which nothing is read any more; others are left alone."""
    for table in tables:
        path = getattr(table, "stored_at", None)
        if path in _MADE:
            _delete(_MADE.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _remove() -> None:
    for path, spark in _MADE.items():
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001, PERF203  the session has ended; the folder is a temporary one
            continue
