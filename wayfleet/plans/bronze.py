"""Landing -> Bronze: nested records plus lineage, partitioned by ingest date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.functions.clock import date_parts
from wayfleet.sources.landing import bucket_of, decoded_path


def to_bronze(records: DataFrame, at: Column | None = None, file_path: str = "file_path") -> DataFrame:
    """Add lineage and ingest-date columns; the nested structure is left alone.

    ``records`` carries the path of its file in ``file_path`` (``parse_landing`` does). Without ``at`` the moment is
    the file's own time, so a batch that is repeated on a later day lands in the same partition.
    """
    if at is None:
        at = F.col("file_time") if "file_time" in records.columns else F.current_timestamp()
    moment = at
    path = F.col(file_path)
    lineage = {
        "ingestion_timestamp": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
        "source_file": decoded_path(path),
        "source_bucket": bucket_of(path),
    }
    return records.withColumns({**lineage, **date_parts(moment, "ingest")}).drop(file_path, "file_size", "file_time")


def require(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split on required keys, found without regard to case: (usable, rejected)."""
    by_lower = {c.lower(): c for c in df.columns}
    absent = [c for c in columns if c.lower() not in by_lower]
    complete = F.lit(not absent)
    for name in columns:
        if name not in absent:
            complete = complete & F.col(by_lower[name.lower()]).isNotNull()
    return df.filter(complete), df.filter(~complete)


def load_audit(parsed: DataFrame) -> DataFrame:
    """One row per landing file: rows in, rows refused, size and outcome."""
    grouped = parsed.groupBy(decoded_path(F.col("file_path")).alias("source_file")).agg(
        F.count_if(F.col("reject_reason").isNull()).alias("rows_loaded"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rows_rejected"),
        F.max("file_size").alias("file_size"),
        F.min("reject_reason").alias("first_reason"),
    )
    outcome = (
        F.when(F.col("rows_rejected") == 0, F.lit("processed"))
        .when(F.col("rows_loaded") == 0, F.lit("failed"))
        .otherwise(F.lit("partial"))
    )
    return grouped.withColumns(
        {"status": outcome, "columns": F.lit(len(parsed.columns) - 5), "audited_at": F.current_timestamp()}
    )
