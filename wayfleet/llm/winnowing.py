"""Benchmark decontamination by winnowing.

Of the hashes of all 5-word grams the least one in every window of 6 grams is kept, in documents and in items alike.
Any 10 consecutive words hold such a window, so each run of 10 words that a document shares with an item shares a kept
gram too: none is missed.  A kept gram of a document that the items may have (a bit table of fixed size
answers) is extended to all 10-word windows that contain it; these windows meet those of the items in a join on
their words, which is the exact check.  Items of fewer than 10 words are one window; grams of just their length are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import PLAIN_WORD, ascii_lower, bounded_batches, flat, row_digest, settle, steps
from wayfleet.llm.words import LOWER, find_words, hash_grams, hash_words, whole_grams

WINDOW = 10
GRAM = 5
# Bits of the table of item grams that tasks get: 4 MB whatever the items are; more items mean more false candidates, not lost ones.
TABLE_BITS = 25

_SPANS = "array<struct<begin:bigint,size:int,words:array<string>>>"


def _kept(grams: np.ndarray, whole: np.ndarray, windows: np.ndarray, room: int) -> np.ndarray:
    """Which grams are the least of some window of ``room`` grams (``windows``: those that lie in one row)."""
    n = len(windows)
    kept = np.zeros(len(grams), bool)
    if n == 0:
        return kept
    least = grams[:n].copy()
    for j in range(1, room):
        np.minimum(least, grams[j : j + n], out=least)
    for j in range(room):
        kept[j : j + n] |= windows & (grams[j : j + n] == least)
    return kept & whole


def _bits(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _listed(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0


def _item_bits(batches: Iterator[pa.RecordBatch], window: int, gram: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column(0))
        low = LOWER[data]
        starts, ends, rows = find_words(data, offsets)
        hashed = hash_words(low, starts, ends)
        counts = np.bincount(rows, minlength=len(offsets) - 1)
        found = {(window, b) for b in _bits(hash_grams(hashed, gram)[_kept(
            hash_grams(hashed, gram), whole_grams(rows, gram), whole_grams(rows, window), window - gram + 1)], bits).tolist()}
        for size in range(1, window):
            first = np.searchsorted(rows, np.flatnonzero(counts == size))
            if len(first):
                found |= {(size, b) for b in _bits(hash_grams(hashed, size)[first], bits).tolist()}
        sizes, slots = zip(*found) if found else ((), ())
        yield pa.record_batch([pa.array(sizes, pa.int32()), pa.array(slots, pa.int64())], ["size", "slot"])


def _document_spans(batches: Iterator[pa.RecordBatch], tables, window: int, gram: int, bits: int) -> Iterator[pa.RecordBatch]:
    held = {size: np.frombuffer(t, np.uint8) for size, t in tables.value.items()}
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("size", pa.int32()), ("words", pa.list_(pa.string()))]))
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        n_words, spans = [], []
        for a, b in steps(offsets):
            part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            low = LOWER[part]
            starts, ends, rows = find_words(part, at)
            counts = np.bincount(rows, minlength=b - a)
            n_words += counts.tolist()
            found: list[list] = [[] for _ in range(b - a)]
            hashed = hash_words(low, starts, ends) if held else None
            first = np.cumsum(counts) - counts
            for size, table in held.items():
                windows = whole_grams(rows, size)
                if size == window:
                    grams = hash_grams(hashed, gram)
                    hit = np.flatnonzero(_kept(grams, whole_grams(rows, gram), windows, window - gram + 1))
                    hit = hit[_listed(table, _bits(grams[hit], bits))]
                    begins = np.unique((hit[:, None] - np.arange(window - gram + 1)).ravel())
                    begins = begins[(begins >= 0) & (begins < len(windows))]
                    begins = begins[windows[begins]]
                else:
                    begins = np.flatnonzero(windows)
                    begins = begins[_listed(table, _bits(hash_grams(hashed, size)[begins], bits))]
                # Windows that begin next to each other become one span of words.
                cuts = np.flatnonzero((np.diff(begins) > 1) | (np.diff(rows[begins]) > 0)) + 1 if len(begins) else []
                for run in np.split(begins, cuts) if len(begins) else []:
                    row, to = int(rows[run[0]]), int(run[-1]) + size
                    text = [low[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") for i in range(int(run[0]), to)]
                    found[row].append({"begin": int(run[0] - first[row]), "size": size, "words": text})
            spans += found
        rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.field(i).name != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch([*rest, pa.array(n_words, pa.int64()), pa.array(spans, kind)], [*names, "n_words", "spans"])


def _windows(words: Column, size: Column) -> Column:
    """All runs of ``size`` words, each as one text, with the place of its first word."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.struct(
        i.cast("long").alias("place"), F.array_join(F.slice(words, i + 1, size), " ").alias("window")))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, window) of all items; an item without a word has none."""
    words = benchmark.select("item_id", F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(PLAIN_WORD), 0).alias("words")).where(F.size("words") > 0)
    found = words.select("item_id", F.explode(_windows(F.col("words"), F.least(F.size("words"), F.lit(window)))).alias("w"))
    return found.select("item_id", "w.window").distinct()


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, table_bits: int = TABLE_BITS) -> DataFrame:
    """(doc_id, row_key, n_words, n_hit, n_items, items) for every document.

    ``n_hit`` counts the words inside any occurrence of an item's window, ``items`` lists the ids of the items with such
    windows, sorted as strings.  Null text has no words and no hits.  An item without id
    counts for hits and is not listed; items with equal ids are one.  Texts of any length are read whole, by one task.  Equal rows get equal results, each its own row; ``row_key`` is
    a digest of id and text.  Empty documents or an empty benchmark give no rows or no hits.  Other columns are ignored.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    slots = benchmark.select("text").mapInArrow(lambda it: _item_bits(it, window, gram, table_bits), "size int, slot long")
    # 64 slots to a row, so what comes to the driver is bounded by the size of the bit table.
    packed = slots.groupBy("size", F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int))) AS bits"))
    tables: dict[int, np.ndarray] = {}
    for row in packed.toLocalIterator():
        tables.setdefault(row["size"], np.zeros(max(1, 1 << (table_bits - 6)), np.int64))[row["word"]] = row["bits"]
    shared = spark.sparkContext.broadcast({size: t.tobytes() for size, t in tables.items()})

    keyed = documents.select("doc_id", row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    scanned = settle(keyed.mapInArrow(
        lambda it: _document_spans(it, shared, window, gram, table_bits), f"doc_id {id_type}, row_key string, n_words long, spans {_SPANS}"), "winnow")

    spans = scanned.where(F.size("spans") > 0).dropDuplicates(["row_key"]).select("row_key", F.explode("spans").alias("s"))
    candidates = spans.select("row_key", "s.begin", "s.size", F.explode(_windows(F.col("s.words"), F.col("s.size"))).alias("w"))
    candidates = candidates.select("row_key", (F.col("begin") + F.col("w.place")).alias("begin"), "size", "w.window")
    listed = settle(item_windows(benchmark, window), "items")
    hits = settle(candidates.join(listed.select("window").distinct(), "window"), "hits")

    # Words covered by the windows of a document: each adds what lies beyond all that began before it.
    before = Window.partitionBy("row_key").orderBy("begin", "size").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("begin") + F.col("size")).over(before), F.lit(0))
    covered = hits.withColumn("more", F.greatest(F.lit(0), F.col("begin") + F.col("size") - F.greatest("begin", reach)))
    covered = covered.groupBy("row_key").agg(F.sum("more").alias("n_hit"))
    items = hits.select("row_key", "window").distinct().join(listed.where("item_id is not null"), "window").select("row_key", "item_id").distinct()
    items = items.groupBy("row_key").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    found = covered.join(items, "row_key", "left")
    nothing = F.array().cast("array<string>")
    return scanned.select("doc_id", "row_key", "n_words").join(found, "row_key", "left").select(
        "doc_id", "row_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(F.coalesce("items", nothing)).cast("long").alias("n_items"),
        F.coalesce("items", nothing).alias("items"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a word inside a benchmark window, as they were."""
    dirty = decontaminate(documents, benchmark, **options).where("n_hit > 0").select(F.col("row_key").alias("__key")).distinct()
    return documents.join(dirty, row_digest(documents["doc_id"], documents["text"]) == dirty["__key"], "left_anti")
