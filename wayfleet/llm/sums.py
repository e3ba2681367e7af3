"""Running sums and exact places along an order, for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import settle

# So many blocks share one row of the level above.
BLOCKS_TOGETHER = 1_000


def _matching(df: DataFrame, offsets: DataFrame, names: Sequence[str]) -> Column:
    same = F.lit(True)
    for name in names:
        same = same & df[name].eqNullSafe(offsets[f"__of_{name}"])
    return same


def running_sums(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Add running sums within ``keys`` along ``block`` and, inside a block, ``order``.

    Three levels: totals of blocks of rows, totals of ``BLOCKS_TOGETHER`` blocks, and the few
    rows above these.  A row's sum is what lies before its group of blocks, before its block in
    that group, and before it in its block.  So no window holds more than a block's rows, ``BLOCKS_TOGETHER``
    blocks, or a millionth of a key's rows, however large the key is.
    """
    names = [*keys, block]
    totals = df.groupBy(*names).agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    totals = totals.withColumn("__high", F.floor(F.col(block) / BLOCKS_TOGETHER).cast("long"))
    high = totals.groupBy(*keys, "__high").agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in sums])
    upper = Window.partitionBy(*keys).orderBy("__high").rowsBetween(Window.unboundedPreceding, -1)
    above = high.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__high").alias("__of___high"),
        *[F.coalesce(F.sum(f"__{n}").over(upper), F.lit(0)).alias(f"__above_{n}") for n in sums])
    lower = Window.partitionBy(*keys, "__high").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.select(*names, "__high", *[F.coalesce(F.sum(f"__{n}").over(lower), F.lit(0)).alias(f"__{n}") for n in sums])
    placed = placed.join(above, _matching(placed, above, [*keys, "__high"]))
    offsets = placed.select(
        *[F.col(k).alias(f"__of_{k}") for k in names], *[(F.col(f"__{n}") + F.col(f"__above_{n}")).alias(f"__{n}") for n in sums])
    out = df.join(offsets, _matching(df, offsets, names))
    inside = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for n, c in sums.items():
        out = out.withColumn(n, F.col(f"__{n}") + F.sum(c).over(inside))
    return out.drop(*[f"__of_{k}" for k in names], *[f"__{n}" for n in sums])


def ranked(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add each row's place (from 1) in one order over the whole table, whose rows must differ under ``order``.

    The rows are dealt into ranges of the order, sorted there and numbered; a range's number of rows moves the
    ranges after it.  No task holds more than a range, also where very many rows share the first columns.  The ranges
    are written down, so a lost executor cannot number them differently.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__n", F.monotonically_increasing_id())
    dealt = settle(dealt.withColumn("__range", F.shiftright("__n", 33)).withColumn("__n", F.col("__n").bitwiseAND((1 << 33) - 1)), "ranges")
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range: as many as the session has shuffle partitions, at most.
    offsets = sizes.select(F.col("__range").alias("__of"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    out = dealt.join(offsets, F.col("__range") == F.col("__of"))
    return out.withColumn(name, F.col("__before") + F.col("__n") + 1).drop("__range", "__of", "__before", "__n")
