"""Incremental sources. The checkpoint remembers which files were consumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from wayfleet.sources.landing import DOCUMENTS, landing_text, parse_landing


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, *, files_per_batch: int | None = None,
                   clean: str = "off", archive: str | None = None, glob: str = "*.json", shape: str = DOCUMENTS) -> DataFrame:
    """Parsed landing files as they arrive; ``shape`` says whether a file is one document or lines.

    ``clean``: "delete" or "archive" removes a source file once the batch that
    contained it has been committed ("archive" moves it under ``archive``).
    """
    options: dict[str, str] = {"cleanSource": clean}
    if archive:
        options["sourceArchiveDir"] = archive
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    return parse_landing(landing_text(spark, path, glob, streaming=True, shape=shape, **options), schema)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, *, files_per_batch: int | None = None,
                   glob: str = "part-*.parquet") -> DataFrame:
    """New Parquet files of a folder, partition columns included. Compacted files have other names and are not new."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain(writer, checkpoint: str) -> StreamingQuery:
    """Start a query that consumes what is there now and then stops; waits for it."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
