"""Landing -> one table, whatever format files come in: a checkpointed stream for each declared format.

The extension says the format. JSON, CSV and Parquet files are parsed into the same columns; what cannot be used goes to one
quarantine with its reason and text, files of any other extension by their names. Each file has an audit row, and
each batch a summary that is observed while its rows are written, without another pass over them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from wayfleet.plans.bronze import load_audit
from wayfleet.sinks.files import append_load
from wayfleet.sources.landing import LINES, accepted, decoded_path, landing_text, parse_csv_lines, parse_landing, rejected
from wayfleet.streaming.sources import drain

_OTHER = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class Paths:
    """Where an ingest reads and writes."""

    landing: str
    table: str
    quarantine: str
    audit: str
    summary: str
    checkpoints: str


Parse = Callable[[DataFrame, T.StructType, Sequence[str]], DataFrame]


def _text(spark: SparkSession, path: str, schema: T.StructType, extension: str) -> DataFrame:
    return landing_text(spark, path, f"*.{extension}", streaming=True, shape=LINES, recursiveFileLookup=True)


def _parquet(spark: SparkSession, path: str, schema: T.StructType, extension: str) -> DataFrame:
    rows = spark.readStream.schema(schema).option("pathGlobFilter", f"*.{extension}").option("recursiveFileLookup", True).parquet(path)
    return rows.select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_modification_time").alias("file_time"))


def _typed(batch: DataFrame, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """Rows that are typed already; only required values are looked at."""
    reason = F.lit(None).cast("string")
    for name in reversed(required):
        reason = F.when(F.col(name).isNull(), f"missing_{name}").otherwise(reason)
    return batch.select(*schema.names, F.to_json(F.struct(*schema.names)).alias("raw"), "file_path", "file_size", "file_time", reason.alias("reject_reason"))


# Format -> how its files are streamed, and how a batch is parsed.
FORMATS: dict[str, tuple[Callable[[SparkSession, str, T.StructType, str], DataFrame], Parse]] = {
    "json": (_text, parse_landing),
    "csv": (_text, parse_csv_lines),
    "parquet": (_parquet, _typed),
}


def _write(parsed: DataFrame, paths: Paths, kind: str, batch_id: int) -> None:
    """The outputs of one batch, each repeatable under the batch's name; the summary is what the writes observed."""
    load = f"{kind}-{batch_id}"
    spark, held = parsed.sparkSession, parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = Observation(f"{load}-good"), Observation(f"{load}-bad")
        rows = accepted(held).withColumn("source_file", decoded_path(F.col("file_path"))).drop("file_path", "file_size", "file_time")
        append_load(rows.observe(good, F.count(F.lit(1)).alias("rows_loaded")), paths.table, [], load)
        refused = rejected(held)
        append_load(refused.observe(bad, F.count(F.lit(1)).alias("rows_rejected")), paths.quarantine, [], load)
        append_load(load_audit(held), paths.audit, [], load)
        figures = {"format": kind, "batch_id": batch_id, "rows_loaded": good.get["rows_loaded"], "rows_rejected": bad.get["rows_rejected"]}
        summary = spark.createDataFrame([tuple(figures.values())], "format string, batch_id bigint, rows_loaded bigint, rows_rejected bigint")
        append_load(summary, paths.summary, [], load)
    finally:
        held.unpersist()


def _unknown_files(spark: SparkSession, paths: Paths, formats: Sequence[str]) -> None:
    """Files of undeclared extensions, once each, into the quarantine by name; their content stays where it is."""
    files = spark.readStream.format("binaryFile").schema(_OTHER).option("recursiveFileLookup", True).load(paths.landing)
    known = F.lower(F.element_at(F.split("path", r"\."), -1)).isin([f.lower() for f in formats])
    other = files.filter(~known).select(
        F.lit("unknown_extension").alias("reject_reason"), F.lit(None).cast("string").alias("raw"), F.col("path").alias("file_path"),
        F.col("length").alias("file_size"), F.col("modificationTime").alias("file_time"))

    def load(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            append_load(rejected(batch), paths.quarantine, [], f"other-{batch_id}")
            append_load(load_audit(batch), paths.audit, [], f"other-{batch_id}")

    drain(other.writeStream.foreachBatch(load), f"{paths.checkpoints}/other")


def ingest(spark: SparkSession, paths: Paths, schema: T.StructType, required: Sequence[str] = (),
           formats: Sequence[str] = tuple(FORMATS)) -> None:
    """Take in every file that arrived since the last call, each once. A declared format that has no reader is an error, not a silence."""
    unknown = sorted(set(formats) - set(FORMATS))
    if unknown:
        raise ValueError(f"no reader for {unknown}; there are {list(FORMATS)}")
    nested = [f.name for f in schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    if nested and "csv" in formats:
        raise ValueError(f"CSV cannot hold {nested}; leave the format out")
    for kind in formats:
        stream, parse = FORMATS[kind]

        def load(batch: DataFrame, batch_id: int, kind=kind, parse=parse) -> None:
            if not batch.isEmpty():
                _write(parse(batch, schema, required), paths, kind, batch_id)

        drain(stream(spark, paths.landing, schema, kind).writeStream.foreachBatch(load), f"{paths.checkpoints}/{kind}")
    _unknown_files(spark, paths, formats)
