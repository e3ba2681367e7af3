"""Fold a batch into a stored table, touching only the partitions it belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.operators.latest import latest_per_key

def by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL on column names; a column missing on one side is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def touched_partitions(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    return df.select(*parts).distinct()


def within_partitions(stored: DataFrame, batch: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of ``stored`` that live in partitions ``batch`` writes to.

    A semi-join on the partition columns; Spark prunes directories at run time from the
    batch's distinct partitions (dynamic partition pruning), however many there are.
    """
    return stored.join(touched_partitions(batch, parts), list(parts), "left_semi")


def not_yet_stored(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``stored``.

    Stored keys are made distinct first: an often-repeated stored key then weighs
    one row in the join, and the join reuses the shuffle of that aggregation.
    """
    return batch.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def upsert_latest(batch: DataFrame, stored: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """Latest row per key over both sides."""
    return latest_per_key(by_name(batch, stored), keys, order)
