"""A table of mergeable partial aggregates, one folder per applied batch.

Applying a batch overwrites its own ``batch_id=`` folder, so applying it twice
changes nothing; that folder name is the ledger. Readers merge the folders. ``fold``
collapses them into one base from time to time and remembers which ids it contains.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wayfleet.schemas import empty, record
from wayfleet.sinks import snapshots
from wayfleet.sinks.files import remove
from wayfleet.sources.tables import folder_exists

_LEDGER = record(applied="string")


def _pending(root: str) -> str:
    return f"{root.rstrip('/')}/pending"


def _base(root: str) -> str:
    return f"{root.rstrip('/')}/base"


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])


def folded_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids already contained in the base."""
    done = snapshots.versions(spark, _base(root))
    if not done:
        return empty(spark, _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{root.rstrip('/')}/ledger/version={done[-1]:06d}")


def is_folded(spark: SparkSession, root: str, batch_id: str) -> bool:
    return not folded_ids(spark, root).filter(F.col("applied") == str(batch_id)).isEmpty()


def apply_batch(partial: DataFrame, root: str, batch_id: str) -> bool:
    """Store the partials of one batch. False if the base already contains it."""
    spark = partial.sparkSession
    if is_folded(spark, root, batch_id):
        return False
    partial.write.mode("overwrite").option("compression", "snappy").parquet(f"{_pending(root)}/batch_id={batch_id}")
    return True


def _pending_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    if not folder_exists(spark, _pending(root)):
        return empty(spark, _with_batch(schema))
    rows = spark.read.schema(_with_batch(schema)).parquet(_pending(root))
    # A fold that stopped before its clean-up leaves folders the base already has;
    # the ledger is a handful of ids per fold, Spark sizes the join itself.
    return rows.join(folded_ids(spark, root), F.col("batch_id") == F.col("applied"), "left_anti")


def merged(spark: SparkSession, root: str, schema: T.StructType,
           merge: Callable[..., DataFrame]) -> DataFrame:
    """Base and pending batches merged into one row per key."""
    return merge(snapshots.current(spark, _base(root), schema), _pending_rows(spark, root, schema).drop("batch_id"))


def fold(spark: SparkSession, root: str, schema: T.StructType, merge: Callable[..., DataFrame],
         partitions: Sequence[str] = ()) -> int:
    """Collapse everything into a new base and return its version.

    Order matters: the ledger of the new version is complete before the version
    itself becomes visible, and pending folders are removed last. A crash at any
    point leaves a table that reads the same. Ids and rows come from one frame, hence
    from one listing of the files: a batch arriving meanwhile simply stays pending.
    """
    pending = _pending_rows(spark, root, schema)
    ids = pending.select(F.col("batch_id").alias("applied")).distinct()
    number = max(snapshots.versions(spark, _base(root), complete_only=False), default=0) + 1
    ledger = f"{root.rstrip('/')}/ledger/version={number:06d}"
    ids.unionByName(folded_ids(spark, root)).distinct().write.mode("overwrite").parquet(ledger)
    # One short id per pending folder, i.e. the batches since the previous fold.
    done = [row.applied for row in ids.collect()]
    base = snapshots.current(spark, _base(root), schema)
    snapshots.publish(merge(base, pending.drop("batch_id")), _base(root), partitions)
    for batch_id in done:
        remove(spark, f"{_pending(root)}/batch_id={batch_id}")
    return number
