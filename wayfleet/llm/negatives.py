"""Hard negatives for contrastive training, by exact scores from subset-sum tables (the method of the Four Russians).

Vectors become whole numbers.  A candidate's components are cut into bit planes, and each plane into bytes of eight dimensions.
For each group of eight dimensions an anchor has a table of the sums of all 256 subsets of its components.  A plane's
byte looks up such a sum; the sums of a plane are added up, and from the highest plane down the total is shifted left and
the next plane added.  The result is the exact inner product.

Candidates are packed into blocks of rows, anchors (the stated query set) into blocks too, and every pair of
blocks is scored once for each of two questions: the best rows of the anchor's own label, then the best rows of other labels
below each positive's score.  Only the few best of a pair of blocks leave its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import bounded_batches, settle

SCALE = 256
# Scaled components beyond this are cut to it, so that no product of vectors of up to 256 dimensions leaves 64 bits.
LARGEST = (1 << 27) - 1
POSITIVES, NEGATIVES = 5, 3
# A negative's score, as hundredths of its positive's.
LOW, HIGH = 50, 95
CANDIDATE_ROWS, ANCHOR_ROWS = 2_048, 512
# Candidate blocks that meet one block of anchors in one task.
BLOCKS_A_TASK = 8
# Anchors whose tables are in use at a time; they fit a processor's cache.
_TABLES = 64

_PACKED = "block long, n int, planes int, groups int, bits binary, ids binary, known binary, labels binary, nos binary"


def _whole(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows of whole numbers, shorter ones filled up with zeros to a multiple of eight dimensions."""
    lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
    values = np.asarray(vectors.flatten().cast(pa.float64()))
    width = -(-int(lengths.max(initial=1) or 1) // 8) * 8
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = np.clip(np.floor(SCALE * values), -LARGEST - 1, LARGEST).astype(np.int64)
    return out


def pack_bits(whole: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes of the rows in two's complement, lowest plane first; the last plane has the sign."""
    planes = max(int(whole.max(initial=0)), -1 - int(whole.min(initial=0))).bit_length() + 1
    return np.stack([np.packbits((whole >> b & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(planes)])


def subset_sums(whole: np.ndarray, kind=np.int64) -> np.ndarray:
    """(groups, 256, rows): for each group of eight components, the sums of all subsets of them."""
    groups = whole.shape[1] // 8
    out = np.zeros((groups, 256, len(whole)), kind)
    for g in range(groups):
        for j in range(8):
            out[g, 1 << j : 2 << j] = out[g, : 1 << j] + whole[:, 8 * g + j].astype(kind)
    return out


def table_scores(tables: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products, from the tables of the anchors and the packed bits of the candidates."""
    groups = min(len(tables), bits.shape[1])
    total = np.zeros((bits.shape[2], tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for plane in reversed(range(len(bits))):
        total <<= 1
        for g in range(groups):
            np.take(tables[g], bits[plane, g], axis=0, out=found)
            total += found
        if plane == len(bits) - 1:
            np.negative(total, out=total)
    return total


def _narrow(anchors: np.ndarray, planes: int) -> type:
    """32 bits where no sum can leave them."""
    largest = int(np.abs(anchors).sum(axis=1).max(initial=0)) << planes
    return np.int32 if largest < 1 << 31 else np.int64


def _packed_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, len(batch), rows):
            part = batch.slice(at, rows)
            whole, ids = _whole(part.column("vector")), part.column("id")
            known = np.asarray(ids.is_valid())
            ids = np.asarray(ids.fill_null(0), dtype=np.int64)
            labels, nos = np.asarray(part.column("label"), dtype=np.int64), np.asarray(part.column("no"), dtype=np.int64)
            # In a block rows of a label stand together, by id, null last.
            order = np.lexsort((nos, ids, ~known, labels))
            bits = pack_bits(whole[order])
            yield pa.record_batch(
                [pa.array([v], t) for v, t in (
                    (block, pa.int64()), (len(part), pa.int32()), (bits.shape[0], pa.int32()), (bits.shape[1], pa.int32()),
                    (bits.tobytes(), pa.binary()), (ids[order].tobytes(), pa.binary()), (known[order].tobytes(), pa.binary()),
                    (labels[order].tobytes(), pa.binary()), (nos[order].tobytes(), pa.binary()))],
                [c.split()[0] for c in _PACKED.split(", ")])
            block += 1


class _Block:
    """A packed block of candidates, read from one row."""

    def __init__(self, row: dict):
        self.bits = np.frombuffer(row["bits"], np.uint8).reshape(row["planes"], row["groups"], row["n"])
        self.ids, self.labels, self.nos = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "nos"))
        self.known = np.frombuffer(row["known"], bool)

    def best(self, begin: int, scores: np.ndarray, anchor: np.ndarray, row: np.ndarray, first: np.ndarray, most: int):
        """Of the listed places of a score matrix the ``most`` best of each value of ``first``, ties by id."""
        value, at = scores[row, anchor], row + begin
        order = np.lexsort((self.nos[at], self.ids[at], ~self.known[at], -value, first))
        first = first[order]
        place = np.arange(len(first)) - np.searchsorted(first, first)
        keep = order[place < most]
        return keep, value[keep], at[keep]


def _best_positives(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row)
            anchors = row["anchors"]
            of = np.array([a["label"] for a in anchors], np.int64)
            whole = _rows_of([a["whole"] for a in anchors])
            out: list[list[np.ndarray]] = [[], [], [], []]
            for label in np.intersect1d(of, block.labels):
                begin, end = np.searchsorted(block.labels, label), np.searchsorted(block.labels, label, side="right")
                same = np.flatnonzero(of == label)
                for cut in range(0, len(same), _TABLES):
                    few = same[cut : cut + _TABLES]
                    scores = table_scores(subset_sums(whole[few], _narrow(whole[few], len(block.bits))), block.bits[:, :, begin:end])
                    own = np.array([anchors[i]["no"] for i in few], np.int64)
                    other = block.nos[begin:end, None] != own[None, :]
                    if end - begin > most + 1:
                        least = np.partition(scores, end - begin - most - 1, axis=0)[end - begin - most - 1]
                        other &= scores >= least
                    r, a = np.nonzero(other)
                    keep, value, at = block.best(begin, scores, a, r, a, most)
                    for held, found in zip(out, (own[a[keep]], value.astype(np.int64), at, block.nos[at])):
                        held.append(found)
            yield _found(block, out, ["anchor_no", "score", "id", "no"])


def _found(block: _Block, out: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
    at = columns[names.index("id")]
    arrays = [pa.array(block.ids[at], mask=~block.known[at]) if n == "id" else pa.array(c) for n, c in zip(names, columns)]
    return pa.record_batch(arrays, names)


def _rows_of(vectors: list[list[int]]) -> np.ndarray:
    width = -(-max((len(v) for v in vectors), default=0) // 8) * 8 or 8
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _best_negatives(batches: Iterator[pa.RecordBatch], most: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row)
            anchors = row["anchors"]
            whole = _rows_of([a["whole"] for a in anchors])
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for cut in range(0, len(anchors), _TABLES):
                few = anchors[cut : cut + _TABLES]
                part = whole[cut : cut + _TABLES]
                scores = table_scores(subset_sums(part, _narrow(part, len(block.bits))), block.bits)
                # The bounds of every positive: low * p <= 100 * n <= high * p.
                owner = np.repeat(np.arange(len(few)), [len(a["positives"]) for a in few])
                score = np.array([s for a in few for s in a["positives"]], np.int64)
                if not len(owner):
                    continue
                least, largest = -((-low * score) // 100), (high * score) // 100
                some = np.full((2, len(few)), [[np.iinfo(np.int64).max], [np.iinfo(np.int64).min]])
                np.minimum.at(some[0], owner, least)
                np.maximum.at(some[1], owner, largest)
                label = np.array([a["label"] for a in few], np.int64)
                r, a = np.nonzero((scores >= some[0]) & (scores <= some[1]) & (block.labels[:, None] != label[None, :]))
                value = scores[r, a].astype(np.int64)
                for p in range(int(np.bincount(owner).max())):
                    # The p-th positive of each anchor, where it has one.
                    has = np.flatnonzero(np.arange(len(owner)) - np.searchsorted(owner, owner) == p)
                    lo, hi = np.full(len(few), 1, np.int64), np.zeros(len(few), np.int64)
                    lo[owner[has]], hi[owner[has]] = least[has], largest[has]
                    fit = np.flatnonzero((value >= lo[a]) & (value <= hi[a]))
                    keep, best, at = block.best(0, scores, a[fit], r[fit], a[fit], most)
                    mine = a[fit][keep]
                    own = np.array([x["no"] for x in few], np.int64)
                    for held, found in zip(out, (own[mine], np.full(len(mine), p + 1), best.astype(np.int64), at, block.nos[at])):
                        held.append(found)
            yield _found(block, out, ["anchor_no", "positive", "score", "id", "no"])


def usable(vector: Column) -> Column:
    """A vector that is there, whose components are all there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def mine(
    vectors: DataFrame, query: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    candidate_rows: int = CANDIDATE_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, the rows that ``query`` picks.

    An anchor's positives are the ``positives`` best other rows of its label; a positive's negatives are the ``negatives`` best
    rows of other labels whose score lies between ``low`` and ``high`` hundredths of the positive's.  Higher scores come first,
    then smaller ids, null ids last.  Rows with a null label, a null vector, or a null or non-finite component take no part.  Rows
    are told apart as rows: copies of an anchor, its id included, count as other rows.  Vectors of unequal length meet in the dimensions both
    have; an empty one scores 0.  Scaled components are cut to 28 bits.  A positive without a fitting negative, and
    an anchor without positives, give no rows; so does an empty table.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), query.alias("query"))
    rows = rows.where(F.col("label").isNotNull() & usable(F.col("vector"))).withColumn("no", F.monotonically_increasing_id())
    rows = settle(rows, "vectors")
    blocks = settle(rows.select("id", "label", "vector", "no").mapInArrow(lambda it: _packed_blocks(it, candidate_rows), _PACKED), "blocks")
    picked = rows.where(F.coalesce("query", F.lit(False)))
    n_blocks, n_anchors = blocks.count(), picked.count()
    parts, slots = max(1, -(-n_anchors // anchor_rows)), max(1, -(-n_blocks // BLOCKS_A_TASK))
    whole = F.transform("vector", lambda x: F.greatest(F.lit(-LARGEST - 1), F.least(F.lit(LARGEST), F.floor(x.cast("double") * SCALE))).cast("long"))
    # A hash of the row's number deals anchors into parts of about anchor_rows rows.
    anchors = picked.select(F.pmod(F.xxhash64("no"), F.lit(parts)).alias("part"), "no", "id", "label", whole.alias("whole"))

    def meet(listed: DataFrame) -> DataFrame:
        """Every pair of a block of candidates and a part of the anchors, as one row."""
        grouped = listed.groupBy("part").agg(F.array_sort(F.collect_list(F.struct(*[c for c in ("no", "label", "whole", "positives") if c in listed.columns]))).alias("anchors"))
        copied = grouped.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        dealt = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return dealt.join(copied, ["part", "slot"]).drop("part", "slot")

    by_score = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("no")]
    found = meet(anchors).mapInArrow(lambda it: _best_positives(it, positives), "anchor_no long, score long, id long, no long")
    best = Window.partitionBy("anchor_no").orderBy(*by_score)
    chosen = settle(found.withColumn("positive", F.row_number().over(best)).where(F.col("positive") <= positives), "positives")
    listed = chosen.groupBy("anchor_no").agg(F.array_sort(F.collect_list(F.struct("positive", "score"))).alias("of"))
    bounded = anchors.join(listed, F.col("no") == F.col("anchor_no")).select(
        "part", "no", "label", "whole", F.transform("of", lambda p: p["score"]).alias("positives"))
    hard = meet(bounded).mapInArrow(
        lambda it: _best_negatives(it, negatives, low, high), "anchor_no long, positive long, score long, id long, no long")
    nearest = Window.partitionBy("anchor_no", "positive").orderBy(*by_score)
    hard = hard.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= negatives)
    named = picked.select(F.col("no").alias("anchor_no"), F.col("id").alias("anchor_id"))
    pairs = chosen.select("anchor_no", "positive", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(named, "anchor_no")
    return hard.select("anchor_no", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        pairs, ["anchor_no", "positive"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
