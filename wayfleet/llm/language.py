"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  For each bit one binary classifier over hashed n-grams of bytes tells the
languages with that bit from those without.  Decoding weighs the loss of each bit by how reliable its
classifier is and takes the language whose codeword costs least; a close second makes the answer ambiguous.

The classifiers share one table of n-gram counts per language, summed by Spark over a bounded sample of
labelled documents; their weights are log odds of these counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import STEP_BYTES, bounded_batches, flat, hash_share, steps
from wayfleet.llm.words import LOWER

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled documents per language to learn from, on average, chosen by a hash of their ids; all if there are fewer.  ``slots``: hashed n-grams, a power of 2.
    ``code_bits``: length of codewords where not all divisions of the languages fit.  ``margin``: a lead in loss below which an answer is ambiguous."""

    sample: int = 4000
    slots: int = 1 << 16
    code_bits: int = 31
    margin: float = 0.5


_NGRAM = 4
# Letters and whatever is not ASCII stay, lower-cased; all else is a gap.
_ALL = np.arange(256)
_LETTER = np.where(((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128), _ALL, 32).astype(np.uint8)[LOWER]
_PIECE = STEP_BYTES // 4


def codewords(languages: list[str], bits: int) -> np.ndarray:
    """A row of +1 and -1 for each language.  All divisions of few languages into two; for more, ``bits`` pseudo-random divisions, no two alike."""
    k = len(languages)
    if 2 ** (k - 1) - 1 <= bits:
        numbers = range(1, 2 ** (k - 1))
        columns = [[(n >> i) & 1 for i in range(k)] for n in numbers]
    else:
        columns, draw = [], np.random.default_rng(k)
        while len(columns) < bits:
            column = draw.permutation(np.arange(k) % 2).tolist()
            if column not in columns and [1 - b for b in column] not in columns:
                columns.append(column)
    return np.array(columns, float).T.reshape(k, -1) * 2 - 1


def _grams(data: np.ndarray, offsets: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of some rows, with a gap before and after each row, and where each row's n-grams begin.  Slot 0 stands for none."""
    rows = len(offsets) - 1
    padded = np.full(len(data) + rows + _NGRAM, 32, np.uint8)
    gaps = offsets + np.arange(rows + 1)
    inside = np.ones(len(padded), bool)
    inside[gaps] = False
    inside[gaps[-1] :] = False
    padded[inside] = _LETTER[data]
    n = len(padded) - _NGRAM + 1
    code = np.zeros(n, np.uint64)
    for j in range(_NGRAM):
        code = (code << np.uint64(8)) | padded[j : j + n]
    slot = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % (slots - 1) + 1
    # An n-gram must not run over the gap between two rows, and one gap after another says nothing.
    for j in range(1, _NGRAM - 1):
        slot[~inside[j : j + n]] = 0
    slot[(code & np.uint64(0xFFFF)) == 0x2020] = 0
    return slot, gaps[:-1]


def _pieces(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with very long rows cut in pieces, and the row of each piece, so that memory does not grow with a text."""
    sizes = np.maximum(1, -(-np.diff(offsets) // _PIECE))
    row = np.repeat(np.arange(len(sizes)), sizes)
    begin = offsets[row] + (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) * _PIECE
    return np.append(begin, offsets[-1]), row


def _sums(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the sum of its n-grams' weights, and the number of n-grams."""
    cuts, row = _pieces(offsets)
    out, counts = np.zeros((len(offsets) - 1, weights.shape[1])), np.zeros(len(offsets) - 1)
    for a, b in steps(cuts, _PIECE):
        slot, begins = _grams(data[cuts[a] : cuts[b]], cuts[a : b + 1] - cuts[a], len(weights))
        np.add.at(out, row[a:b], np.add.reduceat(weights[slot], begins, axis=0, dtype=np.float64))
        np.add.at(counts, row[a:b], np.add.reduceat(slot > 0, begins, dtype=np.int64))
    return out, counts


def _count(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        languages = batch.column("lang").to_pylist()
        totals: dict[str, np.ndarray] = {}
        cuts, row = _pieces(offsets)
        for a, b in steps(cuts, _PIECE):
            slot, begins = _grams(data[cuts[a] : cuts[b]], cuts[a : b + 1] - cuts[a], slots)
            ends = np.append(begins[1:], len(slot))
            for i in range(b - a):
                held = totals.setdefault(languages[row[a + i]], np.zeros(slots, np.int64))
                held += np.bincount(slot[begins[i] : ends[i]], minlength=slots)
        for lang, held in totals.items():
            held[0] = 0
            at = np.flatnonzero(held)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(held[at])], ["lang", "slot", "n"])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    reliability: np.ndarray
    margin: float

    def decide(self, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity for rows of classifier sums."""
        margins = sums / np.maximum(counts, 1)[:, None] / self.scale
        loss = (np.logaddexp(0, -2.0 * margins[:, None, :] * self.codes[None]) * self.reliability).sum(axis=2)
        best = loss.argmin(axis=1)
        p = np.exp(loss.min(axis=1)[:, None] - loss)
        ordered = np.sort(loss, axis=1)
        lead = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        return best, 1.0 / p.sum(axis=1), lead < self.margin


def _training_rows(documents: DataFrame, learn: Column, settings: Settings) -> DataFrame:
    """Text and language of the sample: of each language the share of documents, by a hash of the id, that gives ``sample`` of them on average.

    Documents are counted by language first; the counts, a row per language, come to the driver and become limits in one
    filter, so neither texts nor ids are shuffled.
    """
    rows = documents.where(learn & F.col("lang").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return rows.limit(0).select("lang", "text")
    limits = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, settings.sample / n))])
    # Rows without an id are drawn by their text, so they are a sample too.
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    return rows.where(hash_share(key) < limits[F.col("lang")]).select("lang", "text")


def train(documents: DataFrame, learn: Column, settings: Settings = Settings()) -> Model | None:
    """Fit on rows where ``learn`` holds; None if they name no language."""
    bounded_batches(documents.sparkSession)
    sample = _training_rows(documents, learn, settings)
    counted = sample.mapInArrow(lambda it: _count(it, settings.slots), "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    # At most languages times slots rows, however many documents there are.
    rows = counted.toPandas()
    languages = sorted(set(rows["lang"]), key=lambda s: s.encode())
    if not languages:
        return None
    table = np.zeros((len(languages), settings.slots))
    table[[languages.index(x) for x in rows["lang"]], rows["slot"].to_numpy()] = rows["n"].to_numpy()
    frequency = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)
    codes = codewords(languages, settings.code_bits)
    weights = np.zeros((settings.slots, codes.shape[1]), np.float32)
    for b in range(codes.shape[1]):
        yes, no = frequency[codes[:, b] > 0].mean(axis=0), frequency[codes[:, b] < 0].mean(axis=0)
        weights[:, b] = np.log(yes) - np.log(no)
    weights[0] = 0
    # Each language's mean margin for each bit, from its own frequencies: how far apart and how reliable the classifier is.
    signed = (frequency @ weights) * codes
    scale = np.maximum(np.abs(signed).mean(axis=0), 1e-6)
    reliability = np.clip(signed.min(axis=0) / scale, 0.1, 1.0)
    return Model(languages, codes, weights, scale, reliability, settings.margin)


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) for the whole text of every document.

    Texts that are null or without a letter, and all texts if nothing was learned, are ``und`` with score 0.  ``score`` is the
    share of the best language when losses are read as log likelihoods.  Ties go to the first language by code
    point.  Texts of any length are read whole, very long ones in pieces.  Repeated rows repeat their result, an empty table
    gives an empty one, and other columns are ignored.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            n = batch.num_rows
            names, score, unsure = np.full(n, UNDETERMINED, object), np.zeros(n), np.ones(n, bool)
            if m is not None and n:
                best, p, close = m.decide(*_sums(*flat(batch.column("text")), m.weights))
                names[letters] = np.array(m.languages, object)[best[letters]]
                score[letters], unsure[letters] = p[letters], close[letters]
            yield pa.record_batch([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(unsure)], ["doc_id", "lang_pred", "score", "ambiguous"])

    rows = documents.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(predict, f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean")
