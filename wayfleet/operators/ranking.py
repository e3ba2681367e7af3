"""Top-k and ranks that never gather the table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.operators.ordered import positions


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY .. LIMIT k; each task keeps k rows."""
    return df.orderBy(*order).limit(k)


def top_ranks(df: DataFrame, measure: str, k: int, name: str = "rank") -> DataFrame:
    """Rows whose RANK() by descending ``measure`` (NULLs last) is at most ``k``.

    All ties at the cut are kept. The k best values form a bounded list; whatever
    is larger than a kept value is in that list, so counting there gives the rank.
    """
    best = (
        df.select(measure)
        .filter(F.col(measure).isNotNull())
        .orderBy(F.col(measure).desc())
        .limit(k)
        .agg(F.collect_list(measure))
        .scalar()
    )
    value, listed = F.col(measure), F.col("_best")
    room_left = F.size(listed) < k
    kept = F.when(value.isNull(), room_left).otherwise(room_left | (value >= F.array_min(listed)))
    ahead = F.when(value.isNull(), F.size(listed)).otherwise(F.size(F.filter(listed, lambda b: b > value)))
    return df.withColumn("_best", best).filter(kept).withColumn(name, ahead + 1).drop("_best")


def rank_all(df: DataFrame, measure: str, name: str = "rank") -> DataFrame:
    """RANK() of every row by descending ``measure`` (NULLs last) over the whole frame."""
    return rank_within(df, [], measure, name)


def rank_within(df: DataFrame, keys: Sequence[str], measure: str, name: str = "rank") -> DataFrame:
    """RANK() by descending ``measure`` (NULLs last) inside each group of ``keys``, or over everything.

    Distinct values are ranked by exact running counts in slices; rows get their rank by a join on the value,
    which Spark splits if very many rows share one. No task sorts a whole group, and nothing runs while the plan is built.
    """
    placed = positions(df, measure, keys, descending=True)
    ranks = placed.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_value",
        (F.col("_upto") - F.col("_copies") + 1).cast("int" if keys else "bigint").alias(name),
    )
    same = F.col(measure).eqNullSafe(F.col("_value"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(ranks, same).drop("_value", *[f"_k{i}" for i in range(len(keys))])
