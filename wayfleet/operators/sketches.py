"""Distinct counts over any span of days from one small sketch per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# 2^12 registers: sketches of at most 4 kB.
LOG_K = 12


def error_of(log_k: int = LOG_K) -> float:
    """Relative standard error of an estimate over united sketches: 1.04 / sqrt(2^log_k) for this family."""
    return 1.04 / (1 << log_k) ** 0.5


def sketches(df: DataFrame, keys: Sequence[str], value: str, log_k: int = LOG_K) -> DataFrame:
    """(keys, sketch, n_rows): one sketch of the values of each group, built on the map side; NULLs are not counted."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, log_k).alias("sketch"), F.count("*").alias("n_rows"))


def merge(*frames: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tables of sketches in one: uniting is associative, commutative, and the same value twice counts once."""
    together = frames[0]
    for frame in frames[1:]:
        together = together.unionByName(frame)
    return together.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"))


def estimates(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, distinct_estimate, n_rows) over coarser keys than the sketches were stored by; the raw rows are not read."""
    united = stored.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"))
    return united.select(*keys, F.hll_sketch_estimate("sketch").alias("distinct_estimate"), "n_rows")
