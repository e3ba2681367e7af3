"""Mixing sources to target weights: hash-random order, prefix sums, and a cut at each source's budget.

Documents of a source are put in an order that a hash of their id fixes, by a range sort that also splits rows
of equal ids.  Sizes are summed along that order in three levels (groups of ranges, ranges, and inside a range), so a source or
an id that holds a third of the corpus is spread over many tasks.  A source's budget is cut where the
running sum reaches it; a budget above the source's size takes whole epochs first and cuts
the last one.  Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import WHITE_WORD, free_name, settle
from wayfleet.llm.sums import running_sums

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def size_in_words(text: Column) -> Column:
    """Number of runs of non-blank characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WHITE_WORD)), F.lit(0)).cast("long")


def _wide(name: str) -> Column:
    """Products of totals may exceed 64 bits."""
    return F.col(name).cast("decimal(19,0)")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: rows, size, weight, target and whole-number budget.

    Weights repeat over the sources by code point, null last.  No target goes above
    ``epochs`` times its source's size; what is cut off is dealt to the others by weight.
    With caps c and weights w the level x solves sum(min(w * x, c)) = total: going through the
    sources by c / w, all up to the last one below the level are capped.
    """
    found = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    listed = found.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("long"))
    listed = listed.withColumn("cap", F.col("source_size") * epochs)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = listed.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("shares"),
    ).withColumn("capped", _wide("weight") * _wide("left") > _wide("cap") * _wide("shares"))
    # The first source in that order that is not capped fixes the level for all after it.
    first = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "left", "shares"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * first["left"]).cast("double") / first["shares"].cast("double")
    )
    return level.select("source", "n_rows", "source_size", "weight", target.alias("target")).withColumn(
        "budget", F.least(F.round("target").cast("long"), F.col("source_size") * epochs)
    )


def _taken(numbered: DataFrame, weights: tuple[int, ...], epochs: int, salt: str) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, taken) of rows (row, doc_id, source, size) whose ``row`` is unique."""
    key = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    order = [F.col("key"), F.col("doc_id"), F.col("size"), F.col("row")]
    # The row's number is part of the order, so ranges stay even however many rows share an id.
    dealt = numbered.withColumn("key", key).repartitionByRange(F.col("source"), *order).withColumn("block", F.spark_partition_id().cast("long"))
    dealt = settle(dealt, "mix-ranges")
    targets = source_targets(dealt, weights, epochs).select(F.col("source").alias("of"), "source_size", "target", "budget")
    summed = running_sums(dealt, ["source"], "block", order, {"upto": F.col("size")})
    summed = summed.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("budget") - F.col("whole") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("upto") - F.col("size"))))
    return summed.withColumn("whole", whole.cast("long")).select(
        "row", "doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + part).cast("long").alias("taken")
    )


def _numbered(documents: DataFrame) -> DataFrame:
    # Words are counted once: the narrow table is what ranges, targets and sums are taken from.
    sized = documents.select("doc_id", "source", size_in_words(F.col("text")).alias("size"))
    return settle(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MOST_EPOCHS, salt: str = "mix") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every document.

    ``taken`` counts the words that the mix takes of a document, repeats included: one size per
    whole epoch, plus the part of the last epoch before the cut; only the document at the
    cut is taken in part, so a source's taken words equal its budget exactly.

    Null or blank text has size 0 and takes 0; texts of any length count whole.  Null sources form a source of their own.  Rows
    with equal ids, or null ids, are rows of their own, in order of size; which of two equal rows is cut is the only thing
    left open.  An empty table gives an empty result.  Other columns are ignored.
    """
    return _taken(_numbered(documents), weights, epochs, salt).drop("row")


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MOST_EPOCHS, salt: str = "mix") -> DataFrame:
    """The documents with words taken, as they were, with ``mix_size``, ``mix_taken`` and ``mix_target`` added (input columns of these names go).

    A loader repeats a document ``mix_taken / mix_size`` times; the text is stored once.  The documents are written down with a number
    for each row, so equal rows keep what each of them takes, and no source exceeds its budget.
    """
    kept = documents.drop("mix_size", "mix_taken", "mix_target")
    name = free_name(kept, "row")
    held = settle(kept.withColumn(name, F.monotonically_increasing_id()), "mix-documents")
    sized = settle(held.select("doc_id", "source", size_in_words(F.col("text")).alias("size"), F.col(name).alias("row")), "mix-sizes")
    plan = _taken(sized, weights, epochs, salt).where("taken > 0")
    plan = plan.select(F.col("row").alias(name), F.col("size").alias("mix_size"), F.col("taken").alias("mix_taken"), F.col("target").alias("mix_target"))
    return held.join(plan, name).drop(name)
