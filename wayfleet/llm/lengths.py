"""Exact token-length histogram, and what its suffix sums answer for every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import bounded_batches, settle
from wayfleet.llm.sums import running_sums
from wayfleet.llm.tokens import encoder_of, read_vocabulary

# Lengths are summed in blocks of this many, so that no task needs the whole histogram.
LENGTHS_PER_BLOCK = 256


def token_lengths(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every document: its whole text encoded, special strings as ordinary text.

    Null and empty texts have 0 tokens; texts of any length and any run of white space are encoded whole, by one task.  Equal rows
    and equal ids each give their own row.  The vocabulary file is read by the driver and broadcast; it
    is a fixed file of a few megabytes.  Other columns are ignored.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(shared.value, special=False).ids
        for batch in batches:
            lengths = [len(encode(text.as_py())) for text in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return documents.select("doc_id", "text").mapInArrow(count, f"doc_id {id_type}, n_tokens long")


def length_histogram(lengths: DataFrame, per_block: int = LENGTHS_PER_BLOCK) -> DataFrame:
    """One row per length that occurs, with sums over all documents from that length up.

    ``n_docs`` have exactly that length.  ``docs_upto`` and ``tokens_upto`` count documents and tokens at this length or below,
    ``docs_longer`` and ``tokens_longer`` those above.  ``tokens_truncated`` is the total if every
    document is cut at this length: ``tokens_upto + docs_longer * length``.  ``share_upto`` is the share of documents
    that fit whole.  An empty table gives an empty histogram.
    """
    exact = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    exact = settle(exact.select(F.col("n_tokens").alias("length"), "n_docs", F.floor(F.col("n_tokens") / per_block).alias("block")), "lengths")
    total = exact.agg(F.struct(F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("length")).alias("tokens"))).scalar()
    summed = running_sums(exact.withColumn("every", F.lit(1)), ["every"], "block", [F.col("length")], {"docs_upto": F.col("n_docs"), "tokens_upto": F.col("n_docs") * F.col("length")})
    whole = summed.withColumn("all", total).select("*", F.col("all")["docs"].alias("all_docs"), F.col("all")["tokens"].alias("all_tokens"))
    longer = F.col("all_docs") - F.col("docs_upto")
    return whole.select(
        "length", "n_docs", F.col("docs_upto").cast("long").alias("docs_upto"), F.col("tokens_upto").cast("long").alias("tokens_upto"),
        longer.cast("long").alias("docs_longer"), (F.col("all_tokens") - F.col("tokens_upto")).cast("long").alias("tokens_longer"),
        (F.col("tokens_upto") + longer * F.col("length")).cast("long").alias("tokens_truncated"),
        (F.col("docs_upto") / F.col("all_docs")).alias("share_upto"),
    )


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_whole, docs_cut, tokens_kept, tokens_lost) for each limit asked for, from the counts alone."""
    n, length = F.col("n_docs"), F.col("length")
    asked = histogram.select("length", "n_docs", F.explode(F.array(*[F.lit(x).cast("long") for x in sorted(set(limits))])).alias("context_limit"))
    kept = F.least(length, F.col("context_limit"))
    return asked.groupBy("context_limit").agg(
        F.sum(F.when(length <= F.col("context_limit"), n).otherwise(0)).alias("docs_whole"), F.sum(F.when(length > F.col("context_limit"), n).otherwise(0)).alias("docs_cut"),
        F.sum(n * kept).alias("tokens_kept"), F.sum(n * (length - kept)).alias("tokens_lost"))


def quantile_lengths(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least this share of the documents do not exceed."""
    asked = histogram.select("length", "share_upto", F.explode(F.array(*[F.lit(float(x)) for x in sorted(set(shares))])).alias("share"))
    return asked.where("share_upto >= share").groupBy("share").agg(F.min("length").alias("length"))
