"""Compare two layers of the same data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.operators.latest import beside_latest, content_hash


def reconcile(left: DataFrame, right: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Per key: copies on each side and whether it is matched, changed or missing.

    Matched means that both sides hold the same set of contents, however often each. Each side shrinks to one
    row per (key, content) and then to one per key, so repeated keys neither multiply nor skew the
    join. Sets are compared by their size, the exact sum of their digests and the exclusive or of them.
    """

    def side(df: DataFrame, prefix: str) -> DataFrame:
        contents = df.groupBy(key, content_hash(df, list(compare)).alias("_digest")).agg(F.count("*").alias("_rows"))
        return contents.groupBy(key).agg(
            F.sum("_rows").alias(f"{prefix}_copies"),
            F.struct(
                F.count("*").alias("n"), F.sum(F.col("_digest").cast("decimal(19,0)")).alias("total"),
                F.bit_xor("_digest").alias("odd")).alias(f"_{prefix}"),
        )

    both = side(left, "left").join(side(right, "right"), key, "full_outer")
    same = F.col("_left") == F.col("_right")
    verdict = (
        F.when(F.col("right_copies").isNull(), F.lit("missing_right"))
        .when(F.col("left_copies").isNull(), F.lit("missing_left"))
        .when(same, F.lit("matched"))
        .otherwise(F.lit("changed"))
    )
    none = F.lit(0).cast("bigint")
    return both.select(
        key,
        F.coalesce("left_copies", none).alias("left_copies"),
        F.coalesce("right_copies", none).alias("right_copies"),
        verdict.alias("verdict"),
    )


def reconcile_summary(detail: DataFrame) -> DataFrame:
    return detail.groupBy("verdict").agg(
        F.count("*").alias("keys"),
        F.sum("left_copies").alias("left_rows"),
        F.sum("right_copies").alias("right_rows"),
    )


def beside_survivor(rows: DataFrame, key: str, order: Sequence[str], same: Sequence[str],
                    pairs: Mapping[str, tuple[str, str]], digest: Column) -> DataFrame:
    """``side_by_side`` of the rows that survived deduplication and the survivors, where both layers come from the same rows.

    A row counts as the survivor of its ``key`` if it agrees with it in ``same``; NULLs agree with nothing. ``pairs``:
    output stem -> (column of the one layer, column of the other). One pass and one sort, no join.
    """
    both = beside_latest(rows, [key], order, [*same, *(r for _, r in pairs.values())], digest, "_survivor")
    agrees = F.col(key).isNotNull()
    for name in same:
        agrees = agrees & (F.col(name) == F.col(f"_survivor.{name}"))
    shown = [(F.col(l).alias(f"left_{stem}"), F.col(f"_survivor.{r}").alias(f"right_{stem}")) for stem, (l, r) in pairs.items()]
    return both.filter(agrees).select(key, *(l for l, _ in shown), *(r for _, r in shown))


def side_by_side(left: DataFrame, right: DataFrame, key: str, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Inner join on a unique key showing the same fact in both layers.

    ``pairs``: output stem -> (path on the left, column on the right).
    """
    a = left.select(key, *(F.col(l).alias(f"left_{stem}") for stem, (l, _) in pairs.items()))
    b = right.select(key, *(F.col(r).alias(f"right_{stem}") for stem, (_, r) in pairs.items()))
    return a.join(b, key, "inner")
