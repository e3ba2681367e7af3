"""Whole-table snapshots: write a new folder, readers switch when it is complete.

``root/version=000001``, ``root/version=000002`` ... The current one is the highest
version whose ``_SUCCESS`` marker exists. Spark's committer writes that marker last, so
a half-written version is never seen, and the input of a rewrite is never its output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from wayfleet.schemas import empty
from wayfleet.sinks.files import remove, spread


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str, complete_only: bool = True) -> list[int]:
    target, fs = _fs(spark, root)
    if not fs.exists(target):
        return []
    found = []
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("version="):
            done, _ = _fs(spark, f"{root}/{name}/_SUCCESS")
            if not complete_only or fs.exists(done):
                found.append(int(name.split("=")[1]))
    return sorted(found)


def folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version:06d}"


def publish(df: DataFrame, root: str, partitions: Sequence[str] = (), keep: int = 2) -> int:
    """Write ``df`` as the next version and drop all but the newest ``keep`` versions."""
    spark = df.sparkSession
    number = max(versions(spark, root, complete_only=False), default=0) + 1
    writer = spread(df, partitions).write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(folder(root, number))
    for old in versions(spark, root)[:-keep]:
        remove(spark, folder(root, old))
    return number


def current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The current snapshot; with a ``schema`` an unpublished table is empty, else None."""
    complete = versions(spark, root)
    if not complete:
        return empty(spark, schema) if schema else None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(folder(root, complete[-1]))
