"""Partitioned Parquet writers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfleet.schemas import empty
from wayfleet.sources.tables import folder_exists


def spread(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Gather each output partition on few tasks, by size.

    The rebalance hint lets adaptive execution merge small partitions and split a
    large one over several tasks, so one busy day neither makes thousands of small
    files nor ends up in a single writer.
    """
    return df.hint("rebalance", *partitions) if partitions else df.hint("rebalance")


# Nested or written-down rows take two thirds of the room that they take with the usual codec.
PACKED = "zstd"

# Into up to so many folders at a time a task writes rows as they come.
OPEN_FOLDERS = 8


@contextmanager
def settings(spark: SparkSession, values: dict[str, int | str]) -> Iterator[None]:
    """Session settings for what is planned and run inside."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# A task with rows of few partitions keeps a file open for each. Otherwise Spark sorts all its wide rows by partition first, in
# memory; from ``OPEN_FOLDERS`` on it still does so, for the rows that are left.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FOLDERS}


def append(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    spread(df, partitions).write.mode("append").partitionBy(*partitions).option("compression", "snappy").parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str], as_read: bool = False, codec: str = "snappy") -> None:
    """Overwrite only the partitions that occur in ``df``.

    ``df`` must not read ``path``; see ``rewrite_partitions`` for that case. ``as_read`` leaves rows in the tasks that read
    them, for a frame of few partitions whose files are well-sized already. ``codec``: ``PACKED`` for what is read seldom.
    """
    writer = (
        (df if as_read else spread(df, partitions))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec)
        .partitionBy(*partitions)
    )
    if as_read:
        with settings(df.sparkSession, UNSORTED):
            writer.parquet(path)
    else:
        writer.parquet(path)


def refresh_partitions(df: DataFrame, path: str, partitions: Sequence[str], old: DataFrame) -> None:
    """``replace_partitions``, and removal of the partitions in ``old`` that no longer have rows.

    ``df`` must not read ``path``. Repeating it with the same frames changes nothing. The removed
    partitions are listed on the driver: days or months, a few for a batch.
    """
    spark = df.sparkSession
    emptied = old.select(*partitions).distinct().join(df.select(*partitions).distinct(), list(partitions), "left_anti").collect()
    replace_partitions(df, path, partitions)
    for row in emptied:
        remove(spark, "/".join([path.rstrip("/"), *(f"{name}={row[name]}" for name in partitions)]))


def _staging(path: str) -> str:
    # The leading underscore hides it from readers of the table.
    return f"{path.rstrip('/')}/_staged"


def rewrite_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Overwrite partitions of a table with something computed from that table.

    The result is first written out in full next to the table, then copied over
    the old partitions. Should the copy be interrupted, ``finish_rewrite`` repeats it
    from the finished staging files; nothing has to be recomputed. Call it before
    reading the table that is about to be rewritten.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("compression", "snappy").parquet(_staging(path))
    finish_rewrite(spark, path, partitions)


def finish_rewrite(spark: SparkSession, path: str, partitions: Sequence[str]) -> bool:
    """Publish finished staging files, if there are any. Safe to call at any time."""
    staged = _staging(path)
    if not folder_exists(spark, staged):
        return False
    complete = folder_exists(spark, f"{staged}/_SUCCESS")
    if complete:
        replace_partitions(spark.read.parquet(staged), path, partitions)
    remove(spark, staged)
    return complete


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())


# Compacted files carry this prefix, and streams skip it: what they hold arrived before under other names.
COMPACTED = "compacted-"


def compact(spark: SparkSession, path: str, schema, partitions: Sequence[str], only: Column | None = None) -> None:
    """Merge the files of partitions (all, or those that ``only`` picks by partition columns) into well-sized ones.

    Well-sized copies and a manifest of exactly the files they stand for are written next to the table, both
    from one listing. Publishing moves the copies in and deletes the files in the manifest and no others, so rows
    that are appended at any time, also between an interrupted attempt and its repetition, stay. Compact
    partitions whose files every stream on the table has consumed: streams never read compacted files.
    """
    finish_compaction(spark, path)
    stored = spark.read.schema(schema).parquet(path)
    if only is not None:
        # Raises unless partition columns are all it needs.
        empty(spark, T.StructType([stored.schema[p] for p in partitions])).filter(only)
        stored = stored.filter(only)
    staged = f"{path.rstrip('/')}/_compacting"
    spread(stored, partitions).write.partitionBy(*partitions).option("compression", "snappy").parquet(f"{staged}/data")
    stored.select(F.col("_metadata.file_path").alias("file")).distinct().write.parquet(f"{staged}/manifest")
    finish_compaction(spark, path)


def finish_compaction(spark: SparkSession, path: str) -> bool:
    """Publish a compaction whose manifest is complete, drop one that stopped earlier. Safe to call at any time."""
    root, staged = path.rstrip("/"), f"{path.rstrip('/')}/_compacting"
    if not folder_exists(spark, staged):
        return False
    complete = folder_exists(spark, f"{staged}/manifest/_SUCCESS")
    if complete:
        new_path = spark._jvm.org.apache.hadoop.fs.Path
        data = new_path(f"{staged}/data")
        fs = data.getFileSystem(spark._jsc.hadoopConfiguration())
        files = fs.listFiles(data, True)
        while files.hasNext():
            file = files.next().getPath()
            if file.getName().startswith("part-"):
                inside = file.getParent().toString().split("/_compacting/data", 1)[1]
                fs.mkdirs(new_path(root + inside))
                fs.rename(file, new_path(f"{root}{inside}/{COMPACTED}{file.getName()}"))
        for row in spark.read.parquet(f"{staged}/manifest").toLocalIterator():
            fs.delete(new_path(spark._jvm.java.net.URI(row["file"])), False)
    remove(spark, staged)
    return complete


def written(spark: SparkSession, path: str, schema=None) -> dict[str, int]:
    """Read a table back: how many data files and rows it holds."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    counts = df.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    result = counts.agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    return {"files": result["files"], "rows": result["rows"]}


def footer_counts(spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str] = ()) -> DataFrame:
    """Rows in a folder of Parquet files, per value of its partition columns, from the files' footers alone.

    The count is pushed into the reader, which only the newer Parquet source does; it is chosen for this frame and
    the session's choice put back, so the frame is planned here.
    """
    with settings(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        counts = spark.read.schema(schema).parquet(path).groupBy(*partitions).agg(F.count("*").alias("n_rows"))
        counts._jdf.queryExecution().executedPlan()
        return counts


def append_load(df: DataFrame, path: str, partitions: Sequence[str], load_id: int | str, as_read: bool = False, codec: str = "snappy") -> None:
    """Append to a log so that repeating the same load replaces it.

    ``load_id`` becomes the innermost partition; a retried micro-batch overwrites
    just what its first attempt may have left behind.
    """
    replace_partitions(df.withColumn("load_id", F.lit(str(load_id))), path, [*partitions, "load_id"], as_read, codec)


def write_once(df: DataFrame, path: str, partitions: Sequence[str] = (), as_read: bool = False) -> bool:
    """Write ``df`` as a new folder that appears whole: it is written beside, under a hidden name, and renamed once.

    Does nothing if the folder is there. So a repeated batch neither replaces files that a stream has
    listed nor shows half of them. ``as_read`` leaves rows in the tasks that read them, for a frame whose files are well-sized already.
    """
    spark, target = df.sparkSession, path.rstrip("/")
    if folder_exists(spark, target):
        return False
    parent, name = target.rsplit("/", 1)
    hidden = f"{parent}/_writing-{name.replace('=', '-')}"
    writer = (df if as_read else spread(df, partitions)).write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(hidden)
    _rename(spark, hidden, target)
    return True


def _rename(spark: SparkSession, path: str, target: str) -> None:
    source, goal = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(goal.getParent())
    if not fs.rename(source, goal):
        raise OSError(f"cannot rename {path} to {target}")


def move_once(spark: SparkSession, path: str, target: str) -> bool:
    """``write_once`` for a folder that is written already: it becomes the new one by the one rename, without a copy."""
    if folder_exists(spark, target):
        return False
    _rename(spark, path, target)
    return True


def write_apart(df: DataFrame, path: str, kind: str) -> None:
    """Write ``df`` once, a folder for each of the few values of ``kind``, unless a finished copy is there."""
    spark = df.sparkSession
    if not folder_exists(spark, f"{path}/_SUCCESS"):
        with settings(spark, UNSORTED):
            df.write.mode("overwrite").option("compression", PACKED).partitionBy(kind).parquet(path)


def materialise_once(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` unless a finished copy is there, and read it back.

    Everything downstream then reads files: a lost executor or a retried batch sees
    the same rows, even if the inputs of ``df`` have moved on.
    """
    spark = df.sparkSession
    if not folder_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
