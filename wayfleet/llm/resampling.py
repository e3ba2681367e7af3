"""Importance resampling towards a target text collection by hashed word runs.

A Regex Split of the tokenizers library, which is never trained, gives the words of the ASCII-lowered text as pairs of
byte offsets.  Windows over these pairs are the runs of one to three words; the CRC-32 of a run follows from those of
its words, since the CRC of two texts in a row is the first one's, moved on by the second one's length, xor the second one's.
Runs are counted in buckets, in the documents and in the target; a bucket's gain is the logarithm of the ratio of its two
shares, and a document weighs the sum of the gains of its runs.  With a Gumbel variate added that a hash of the id
fixes, the documents of highest score are a draw without replacement by importance.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import PLAIN_WORD, STEP_BYTES, bounded_batches, settle
from wayfleet.llm.sums import ranked

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

# Texts are split in parts of about this many characters, cut where no word is.
PART = 1 << 15
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_SHORT = 64


def _table() -> np.ndarray:
    """CRC-32 of single bytes, by the reflected polynomial of ISO 3309."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_BYTE = _table()
_LOW = np.uint32(0xFF)


def _apply(moves: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of CRCs, given by its values for each of their four bytes."""
    out = moves[0][crc & _LOW]
    for k in (1, 2, 3):
        out = out ^ moves[k][(crc >> np.uint32(8 * k)) & _LOW]
    return out


def _moves() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps that move a CRC on by 0 to ``_SHORT`` bytes, as one array, and by powers of two."""
    at = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    short = [at]
    for _ in range(_SHORT):
        at = _BYTE[at & _LOW] ^ (at >> np.uint32(8))
        short.append(at)
    powers = [short[1]]
    for _ in range(40):
        powers.append(_apply(powers[-1], powers[-1]))
    return np.stack(short), powers


_MOVES, _POWERS = _moves()
_BLANK = np.uint32(zlib.crc32(b" "))


def moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each CRC moved on by its own number of bytes."""
    n = np.minimum(by, _SHORT)
    out = _MOVES[n, 0, crc & _LOW]
    for k in (1, 2, 3):
        out ^= _MOVES[n, k, (crc >> np.uint32(8 * k)) & _LOW]
    for i in np.flatnonzero(by > _SHORT):
        rest, c = int(by[i]) - _SHORT, out[i : i + 1]
        for k, power in enumerate(_POWERS):
            if rest >> k & 1:
                c = _apply(power, c)
        out[i] = c[0]
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every word: all first bytes, then all second ones, and so on."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, _SHORT + 1), kind="stable")
    begin, size = starts[order], lengths[order]
    falling = -np.minimum(size, _SHORT + 1)
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long_ones = int(np.searchsorted(falling, -_SHORT, side="left"))
    for j in range(min(_SHORT, int(size.max(initial=0)))):
        to = int(np.searchsorted(falling, -j, side="left"))
        crc[:to] = _BYTE[(crc[:to] ^ data[begin[:to] + j]) & _LOW] ^ (crc[:to] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(long_ones):
        crc[i] = zlib.crc32(data[begin[i] : begin[i] + size[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _parts(text: str) -> Iterator[str]:
    """A text in parts that no word crosses; all but a part with one very long word have about ``PART`` characters."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PART)
        to = gap.start() if gap else len(text)
        yield text[at:to]
        at = to


class Splitter:
    """``words(text)``: byte offsets of the words in the text's UTF-8 bytes, as two arrays."""

    def __init__(self, pattern: str = PLAIN_WORD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import PreTokenizedString, Regex
        from tokenizers.pre_tokenizers import Split

        self._text, self._split = PreTokenizedString, Split(Regex(pattern), behavior="removed", invert=True)

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found, base = [], 0
        for part in _parts(text):
            held = self._text(part)
            self._split.pre_tokenize(held)
            pairs = held.get_splits(offset_referential="original", offset_type="byte")
            found.append(np.fromiter(chain.from_iterable(map(itemgetter(1), pairs)), np.int64, 2 * len(pairs)) + base)
            base += len(part.encode())
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        return flat[::2], flat[1::2]


def run_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every run of 1 to ``longest`` words that lies in one row."""
    crc, lengths = word_crcs(data, starts, ends), ends - starts
    joined = moved(np.full(len(crc), _BLANK), lengths) ^ crc
    found, owners, run = [], [], crc
    for size in range(1, longest + 1):
        if size > 1:
            run = moved(run[:-1], lengths[size - 1 :] + 1) ^ joined[size - 1 :]
        whole = rows[: len(run)] == rows[size - 1 :]
        found.append((run[whole] % np.uint32(buckets)).astype(np.int64))
        owners.append(rows[: len(run)][whole])
        if len(run) < 2:
            break
    return np.concatenate(owners), np.concatenate(found)


def _feature_batches(batches: Iterator[pa.RecordBatch], buckets: int, longest: int) -> Iterator[pa.RecordBatch]:
    splitter = Splitter()
    for batch in batches:
        texts = batch.column("text")
        rest = [batch.column(n) for n in batch.schema.names if n != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        n_words, n_features, packed = [], [], []
        at = 0
        while at < len(texts):
            # A step holds about STEP_BYTES of text, or one longer text.
            held, size, first = [], 0, at
            while at < len(texts) and (not held or size < STEP_BYTES):
                held.append((texts[at].as_py() or "").encode().lower())
                size += len(held[-1])
                at += 1
            base, starts, ends, counts = 0, [], [], []
            for low in held:
                a, b = splitter.words(low.decode())
                starts.append(a + base)
                ends.append(b + base)
                counts.append(len(a))
                base += len(low)
            rows = np.repeat(np.arange(at - first), counts)
            data = np.frombuffer(b"".join(held), np.uint8)
            owners, found = run_buckets(data, np.concatenate(starts), np.concatenate(ends), rows, buckets, longest)
            keyed = np.sort(owners * buckets + found)
            owners, found = keyed // buckets, keyed % buckets
            cuts = np.searchsorted(owners, np.arange(at - first + 1))
            steps = np.diff(found, prepend=0)
            begins = cuts[:-1][cuts[:-1] < cuts[1:]]
            steps[begins] = found[begins]
            small = steps.astype("<u2" if buckets <= 1 << 16 else "<u4")
            n_words += counts
            n_features += np.diff(cuts).tolist()
            packed += [small[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.record_batch(
            [*rest, pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(packed, pa.binary())],
            [*names, "n_words", "n_features", "runs"])


def features(df: DataFrame, keep: tuple[str, ...] = (), buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """(keep.., n_words, n_features, runs): the buckets of all runs of words of ``text``, sorted, as differences in little-endian integers.

    Null text has no words.  Whole texts are read, in parts; only one row's words are held at a time beside a step of short rows.
    """
    bounded_batches(df.sparkSession)
    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    layout = ", ".join([*kept, "n_words long", "n_features long", "runs binary"])
    return df.select(*keep, "text").mapInArrow(lambda it: _feature_batches(it, buckets, longest), layout)


def _unpacked(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all rows in a row, and where each row's begin and end."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = (at - at[0]) // width
    upto = np.concatenate(([0], np.cumsum(raw.view(f"<u{width}").astype(np.int64))))
    return upto[1:] - np.repeat(upto[at[:-1]], np.diff(at)), at


def histogram(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many runs all rows have in each bucket; a task gives at most one row for each bucket."""
    width = 2 if buckets <= 1 << 16 else 4

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column(0), width)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return found.select("runs").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Whole-number gain of each bucket: floor(1000 * ln) of its share in ``target`` to that in ``source``, both smoothed by one.

    Two histograms of ``buckets`` rows come to the driver, whatever the tables' size.
    """
    counts = []
    for found in (source, target):
        n = [0] * buckets
        for row in histogram(found, buckets).collect():
            n[row["bucket"]] = row["n"]
        counts.append(n)
    s, t = counts
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((t[i] + 1) * all_s / ((s[i] + 1) * all_t))) for i in range(buckets)], np.int64)


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows of ``features`` with ``weight``, the sum of the gains of their runs, instead of the runs."""
    width, shared = 2 if len(gain) <= 1 << 16 else 4, found.sparkSession.sparkContext.broadcast(gain)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, at = _unpacked(batch.column("runs"), width)
            upto = np.concatenate(([0], np.cumsum(shared.value[runs])))
            names = [n for n in batch.schema.names if n != "runs"]
            yield pa.record_batch([*[batch.column(n) for n in names], pa.array(upto[at[1:]] - upto[at[:-1]])], [*names, "weight"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "runs"]
    return found.mapInArrow(total, ", ".join([*kept, "weight long"]))


def gumbel(key: Column, seed: int = SEED) -> Column:
    """A Gumbel variate in whole thousandths, fixed by a hash of ``seed`` and the key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h.cast("double") + 0.5) / 4294967296.0)))


def resample(
    documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document.

    Of the documents with at least ``least_words`` words the ``percent`` of a hundred with the highest scores are drawn and ranked from
    1; others have rank null.  Ties go to the smaller doc_id, null last, and among rows equal in both to whichever was
    written first: such rows are interchangeable, yet each is drawn or not on its own.  Null and empty texts have no runs, weight 0 and their
    variate as score; a null id has the variate of an empty one.  With an empty target every bucket's gain only levels the documents' own
    shares; without documents the result is empty.  Columns other than doc_id and text are ignored.
    """
    # Each text is split once; what is written down are its bucket numbers, about half a byte to a byte a run.
    keyed = documents.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    found = settle(features(keyed, ("doc_id", "row"), buckets, longest), "runs", "zstd")
    gain = gains(found, features(target, (), buckets, longest), buckets)
    eligible = F.col("n_words") >= least_words
    scored = weigh(found, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    drawn = found.where(eligible).agg(F.floor(F.count(F.lit(1)) * percent / 100)).first()[0]
    # Rows that cannot be drawn go after all that can, so a place up to the number drawn is the rank.
    order = [F.when(eligible, 0).otherwise(1), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = ranked(scored, order)
    rank = F.when((F.col("position") <= int(drawn)) & eligible, F.col("position"))
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.cast("long").alias("rank"))
