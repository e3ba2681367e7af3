"""One row per key: the newest, the furthest, the only one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _descending(order: Sequence[str | Column]) -> list[Column]:
    return [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]


def content_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """64-bit digest of a row; map columns (none in our layouts) cannot be hashed."""
    names = columns or [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.expr(f"xxhash64({', '.join(f'`{n}`' for n in names)})")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   settle_ties: bool = True) -> DataFrame:
    """Keep the row that sorts first by ``order`` (all descending, NULLs last).

    ``settle_ties`` adds the row digest as last criterion, so the answer does not
    depend on how rows were spread over tasks. Spark reduces every input partition
    to one row per key before the shuffle (WindowGroupLimit), so a key that owns a
    large part of the table sends at most one row per task over the network.
    """
    ranking = _descending(order)
    if settle_ties:
        ranking.append(content_hash(df).desc())
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def may_be_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], row_id: str,
                  parts: int) -> DataFrame:
    """Rows among which ``latest_per_key`` finds what it finds in ``df``: far fewer than ``df`` has.

    Places are given to rows of keys, order and ``row_id`` alone, so no wide row is sorted or moved by key. With many keys
    a task holds few rows of each and reduces little before the shuffle. The rows of the winning ids follow by a
    join on the id, which needs no shuffle of ``df`` if it is dealt out by it over ``parts`` tasks; rows without an id all stay.
    """
    window = Window.partitionBy(*keys).orderBy(*_descending(order))
    first = df.withColumn("_place", F.rank().over(window)).filter("_place = 1")
    ids = first.filter(F.col(row_id).isNotNull()).select(F.col(row_id).alias("_winner"))
    ids = ids.repartition(parts, "_winner").distinct()
    return df.join(ids, F.col(row_id) == F.col("_winner"), "left_outer").filter(
        F.col("_winner").isNotNull() | F.col(row_id).isNull()).drop("_winner")


def beside_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], values: Sequence[str],
                  digest: Column, name: str = "latest") -> DataFrame:
    """Every row with the ``values`` of its key's latest row beside it, as a struct, by one sort.

    ``order`` and ``digest`` settle which row that is as in ``latest_per_key``.
    """
    window = Window.partitionBy(*keys).orderBy(*_descending(order), digest.desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.first(F.struct(*values)).over(window))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact-row distinct; copies collapse before the shuffle."""
    return df.distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "copies") -> DataFrame:
    """Keys that occur more than once. Empty for a correct snapshot."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).filter(F.col(count_name) > 1)


def reduction_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, what deduplication would remove, and that as a percentage."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    removed = F.col("total_rows") - F.col("distinct_keys")
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_keys")
    ).select(
        "total_rows",
        "distinct_keys",
        removed.alias("removed_rows"),
        F.round(F.try_divide(removed * 100.0, F.col("total_rows")), 1).alias("reduction_pct"),
    )
