"""Running sums and exact positions along an order, without any task that needs a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_sums(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Add running sums within ``keys``, in two levels.

    ``block`` names an integer column that cuts each group into ordered ranges. Totals by (keys, block)
    come first; a row then gets the total of the blocks before its own plus its running sum inside
    the block, so a group that holds a third of the table is spread over many tasks.
    """
    totals = df.groupBy(*keys, block).agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(block).alias("__block"),
        *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums],
    )
    same = F.col(block) == F.col("__block")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.join(offsets, same)
    for n, c in sums.items():
        out = out.withColumn(n, F.col(f"__{n}") + F.sum(c).over(inside))
    return out.drop("__block", *[f"__k{i}" for i in range(len(keys))], *[f"__{n}" for n in sums])


def positions(df: DataFrame, measure: str, keys: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """(keys, _value, _copies, _upto): each distinct value of a numeric measure, its count, and the exact number of rows up to it.

    NULLs come last. Values are cut into as many ordered slices per group as the session has shuffle
    partitions, at approximate quantiles; these only steer the balance. A value that very many
    rows share is one row here, counted on the map side.
    """
    slices = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = df.groupBy(*keys, F.col(measure).alias("_value")).agg(F.count("*").alias("_copies"))
    quantiles = F.percentile_approx("_value", [i / slices for i in range(1, slices)], slices * 20)
    if keys:
        cuts = values.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(quantiles.alias("_cuts"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        sliced = values.join(cuts, same).drop(*[f"_k{i}" for i in range(len(keys))])
    else:
        sliced = values.withColumn("_cuts", values.agg(quantiles).scalar())
    ahead = F.size(F.filter("_cuts", (lambda c: c > F.col("_value")) if descending else (lambda c: c < F.col("_value"))))
    place = F.when(F.col("_value").isNull(), slices + 1).otherwise(F.coalesce(ahead, F.lit(0)))
    order = F.col("_value").desc_nulls_last() if descending else F.col("_value").asc_nulls_last()
    placed = sliced.withColumn("_slice", place).drop("_cuts")
    return running_sums(placed, keys, "_slice", [order], {"_upto": F.col("_copies")}).drop("_slice")


def quantiles(df: DataFrame, measure: str, fractions: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per group with the exact quantiles named in ``fractions``: the least value that at least this share of the values does not exceed."""
    known = df.filter(F.col(measure).isNotNull())
    placed = positions(known, measure, keys)
    totals = known.groupBy(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("_total"))
    if keys:
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_t{i}"))
        placed = placed.join(totals, same).drop(*[f"_t{i}" for i in range(len(keys))])
    else:
        placed = placed.withColumn("_total", totals.scalar())
    return placed.groupBy(*keys).agg(
        *[F.min(F.when(F.col("_upto") >= F.ceil(F.col("_total") * p), F.col("_value"))).alias(n) for n, p in fractions.items()])
