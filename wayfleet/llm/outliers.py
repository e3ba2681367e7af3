"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source.

Counts of each text become a vector of four transformed ratios.  For each (language, source) the share of documents whose
covariance has the least determinant is searched for by concentration steps from several starts, all groups and starts at once: a
step sorts distances into bins and sums moments by (group, start, bin), so a task sends a few
numbers per bin, start and group, however many documents a group has.  After two steps each group keeps its start of least determinant
and goes on from there.  A document is rejected if its Mahalanobis distance from its group is too large.  All statistics cover all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import bounded_batches, row_digest, settle

STATS = ("word_length", "symbols", "dup_lines", "repeats")


@dataclass(frozen=True)
class Rules:
    """``core``: share of documents the determinant is minimised over; their covariance is widened to that of all under normality.
    ``cutoff``: largest squared distance kept, the 0.999 quantile of chi-squared with 4 degrees of freedom.  ``least_spread``: standard
    deviations of the four statistics over a group are taken as these at least, so that a statistic that hardly varies in clean text does not reject on a
    trifle; the sampling error of each text, which its length gives, comes on top.  ``pooled``: weight, in documents, of the mean covariance within
    all groups in each group's own.  ``few``: a group whose core has fewer documents than this has a centre made up to that number by the
    centre of all groups; others keep their own.  ``first_steps`` are taken from every start, ``rounds`` in all."""

    core: float = 0.75
    cutoff: float = 18.47
    least_spread: tuple[float, ...] = (0.05, 0.05, 0.05, 0.05)
    pooled: float = 20.0
    few: int = 10
    first_steps: int = 2
    rounds: int = 5


_SYMBOLS = b"#*$%&|<>"
_BLANK = b" \t\n\r\x0b\x0c"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _count(text: bytes) -> tuple[int, ...]:
    words = text.split()
    n = len(words)
    if n == 0:
        return 0, 0, len(text) - len(text.translate(None, _SYMBOLS)), 0, 0, 0
    # Bytes that continue a character do not begin one.
    chars = text.translate(None, _BLANK)
    codes = np.frombuffer(chars, np.uint8)
    word_chars = len(codes) - int(((codes & 0xC0) == 0x80).sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    if n > 3:
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        m = len(numbers)
        pairs = ids[:-2] * m + ids[1:-1]
        _, pairs = np.unique(pairs, return_inverse=True)
        _, which, counts = np.unique(pairs * m + ids[2:], return_inverse=True, return_counts=True)
        again = counts[which] > 1
        covered = np.zeros(n, bool)
        for j in range(3):
            covered[j : n - 2 + j] |= again
        repeated = int(covered.sum())
    return n, word_chars, len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_count(text.as_buffer().to_pybytes() if text.is_valid else b"") for text in batch.column("text").cast(pa.large_binary())]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_COUNTS))]
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch([*[batch.column(n) for n in rest], *columns], [*rest, *_COUNTS])


def text_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, row_key, lang, source, counts) of every whole text; null has no words."""
    bounded_batches(documents.sparkSession)
    keyed = documents.select("doc_id", row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(_counted, f"doc_id {id_type}, row_key string, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> Column:
    """The four statistics on scales on which clean text is about normal.  Shares are damped by a few words or lines, since short texts vary more."""
    n = F.greatest(F.col("n_words"), F.lit(1))

    def share(part: str, whole: Column) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / whole)))

    return F.array(
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.log1p(20 * F.col("n_symbols") / (n + 5)),
        share("n_dup_lines", F.col("n_lines") + 5),
        share("n_repeat_words", n + 50),
    )


def consistency(core: float) -> float:
    """By how much the covariance of the ``core`` share of normal vectors nearest to their centre falls short of that of all (4 statistics)."""
    if core >= 1:
        return 1.0
    low, high = 0.0, 200.0
    for _ in range(80):
        q = (low + high) / 2
        low, high = (q, high) if 1 - math.exp(-q / 2) * (1 + q / 2) < core else (low, q)
    return core / (1 - math.exp(-q / 2) * (1 + q / 2 + q * q / 8))


def _sampling_variance(n: np.ndarray, lines: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Variance of each statistic of a text around its group's ``centre`` that comes from its length alone.

    One word's length varies by about 0.6 of the mean; symbols are counts, with one more event than expected; lines are trials of their own;
    repeated words come in passages, nine to one.
    """
    rate = np.maximum(0.0, np.expm1(centre[:, 1])) / 20
    slope = 20 / (n + 5) / (1 + 20 * rate)
    return np.column_stack([0.36 / n, slope**2 * (rate * n + 1), 0.25 / (lines + 5), 0.25 * 9 / (n + 50)])


_P = len(STATS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_BINS = 512


def _distance(centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance of ``x``; ``inverse`` holds the upper triangle of the inverse covariance."""
    d = [F.col("x")[i] - centre[i] for i in range(_P)]
    terms = [d[i] * d[j] * inverse[k] * (1.0 if i == j else 2.0) for k, (i, j) in enumerate(_PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(F.lit(0.0), total)


_NAMES = ["n", *[f"s{i}" for i in range(_P)], *[f"q{i}{j}" for i, j in _PAIRS]]
_GROUP = ["lang", "source"]
_RAW = "centre array<double>, cov array<double>, n double, log_det double"


def _moments() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(_P)], *[F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"q{i}{j}") for i, j in _PAIRS]]


def _lifted(cov: np.ndarray, least_spread: np.ndarray) -> np.ndarray:
    """Floors on the scale of each statistic; its correlations stay, but for a trifle that keeps the matrix regular."""
    scale = np.maximum(np.diag(cov), least_spread**2)
    return cov + np.diag(scale * (1 + 1e-7) - np.diag(cov))


def _square(upper: list[float]) -> np.ndarray:
    out = np.zeros((_P, _P))
    for (i, j), v in zip(_PAIRS, upper):
        out[i, j] = out[j, i] = v
    return out


def _upper(matrix: np.ndarray) -> list[float]:
    return [float(matrix[i, j]) for i, j in _PAIRS]


def _core_moments(batches: Iterator, rules: Rules) -> Iterator:
    """Summed moments of cores to their centre, covariance and its determinant, floors included."""
    least = np.array(rules.least_spread)
    for frame in batches:
        centres, covs, dets = [], [], []
        for row in frame.itertuples(index=False):
            mean = np.array([getattr(row, f"s{i}") for i in range(_P)]) / row.n
            cov = _square([getattr(row, f"q{i}{j}") / row.n for i, j in _PAIRS]) - np.outer(mean, mean)
            centres.append(mean.tolist())
            covs.append(_upper(cov))
            dets.append(float(np.linalg.slogdet(_lifted(cov, least))[1]))
        yield frame[[*_GROUP, "start"]].assign(centre=centres, cov=covs, n=frame["n"].astype(float), log_det=dets)


def _inverted(batches: Iterator, rules: Rules) -> Iterator:
    least, widen = np.array(rules.least_spread), consistency(rules.core)
    for frame in batches:
        yield frame.assign(inverse=[_upper(np.linalg.inv(_lifted(_square(c) * widen, least))) for c in frame["cov"]])


def _starts(rows: DataFrame, rules: Rules) -> DataFrame:
    """(lang, source, start, centre, cov): the median with the least spreads, the median and the first quartile with spreads by the
    quartiles, and the mean with the covariance of all, for every group."""
    quartiles = [F.percentile_approx(F.col("x")[i], [0.25, 0.5, 0.75], 1000).alias(f"p{i}") for i in range(_P)]
    found = rows.groupBy(*_GROUP).agg(*_moments(), *quartiles)
    least = [F.lit(v) for v in rules.least_spread]

    def diagonal(value) -> Column:
        return F.array(*[value(i) if i == j else F.lit(0.0) for i, j in _PAIRS])

    def quartile(k: int) -> Column:
        return F.array(*[F.col(f"p{i}")[k].cast("double") for i in range(_P)])

    between = diagonal(lambda i: F.pow(F.greatest(least[i], (F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349), 2))
    mean = [F.col(f"s{i}") / F.col("n") for i in range(_P)]
    every = F.array(*[F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j] for i, j in _PAIRS])
    kinds = [(quartile(1), diagonal(lambda i: least[i] * least[i])), (quartile(1), between), (quartile(0), between), (F.array(*mean), every)]
    return found.select(*_GROUP, F.inline(F.array(*[F.struct(F.lit(k).alias("start"), c.alias("centre"), v.alias("cov")) for k, (c, v) in enumerate(kinds)])))


def _step(rows: DataFrame, estimates: DataFrame, rules: Rules) -> DataFrame:
    """One concentration step of every start: the bins of smallest distance that hold ``core`` of a group's documents; the last bin needed is kept whole."""
    layout = f"lang string, source string, start int, {_RAW}"
    current = estimates.select(*_GROUP, "start", "centre", "cov").mapInPandas(
        lambda it: _inverted(it, rules), "lang string, source string, start int, centre array<double>, cov array<double>, inverse array<double>")
    e = current.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "start", "centre", "inverse")
    placed = rows.join(e, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))).drop("_lang", "_source")
    placed = placed.withColumn("d2", _distance(F.col("centre"), F.col("inverse")))
    # Bins are even in the logarithm of the distance: fine where documents are dense, and none is out of range.
    bin_no = F.least(F.lit(_BINS), F.floor(F.log1p(F.col("d2") * 64) * 32)).cast("int")
    binned = placed.withColumn("bin", bin_no).groupBy(*_GROUP, "start", "bin").agg(*_moments())
    core = binned.withColumn("upto", F.sum("n").over(_order("bin"))).withColumn("total", F.sum("n").over(_order(None)))
    core = core.where(F.col("upto") - F.col("n") < F.ceil(F.col("total") * rules.core)).groupBy(*_GROUP, "start").agg(*[F.sum(c).alias(c) for c in _NAMES])
    return settle(core.mapInPandas(lambda it: _core_moments(it, rules), layout), "estimates")


def least_determinants(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(lang, source, start, centre, cov, n, log_det) of the core found for every group of ``rows`` (lang, source, x): of the starts, the one of least determinant."""
    estimates = settle(_starts(rows, rules), "estimates")
    for number in range(rules.rounds):
        estimates = _step(rows, estimates, rules)
        if number + 1 == min(rules.first_steps, rules.rounds):
            best = F.min_by(F.struct("start", "centre", "cov", "n", "log_det"), F.struct("log_det", "start"))
            estimates = settle(estimates.groupBy(*_GROUP).agg(best.alias("best")).select(*_GROUP, "best.*"), "estimates")
    return estimates


def _pooled(batches: Iterator, rules: Rules) -> Iterator:
    """Groups' cores, with the mean centre and covariance of all beside them, to the centre and covariance that documents are judged by."""
    least, widen = np.array(rules.least_spread), consistency(rules.core)
    for frame in batches:
        centres, covs, inverses = [], [], []
        for row in frame.itertuples(index=False):
            lent = max(0.0, rules.few - row.n)
            centres.append(((row.n * np.array(row.centre) + lent * np.array(row.all_centre)) / (row.n + lent)).tolist())
            cov = (row.n * _square(row.cov) + rules.pooled * _square(row.all_cov)) / (row.n + rules.pooled)
            cov = _lifted(cov * widen, least)
            covs.append(_upper(cov))
            inverses.append(_upper(np.linalg.inv(cov)))
        yield frame[_GROUP].assign(centre=centres, cov=covs, inverse=inverses)


def robust_estimates(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(lang, source, centre, cov, inverse) for every group of ``rows`` (lang, source, x): the core of least determinant, its covariance widened to all and
    shrunk towards the mean of the covariances within groups.  The centre is the group's own, unless it has very few documents."""
    cores = least_determinants(rows, rules)

    def mean_of(column: str, size: int) -> list[Column]:
        return [(F.sum(F.col(column)[i] * F.col("n")) / F.sum("n")).alias(f"{column}{i}") for i in range(size)]

    # One row: weighted means over the groups.
    sums = cores.agg(F.struct(*mean_of("centre", _P), *mean_of("cov", len(_PAIRS)))).scalar()
    both = cores.select(*_GROUP, "centre", "cov", "n", sums.alias("of")).select(
        *_GROUP, "centre", "cov", "n", F.array(*[F.col(f"of.centre{i}") for i in range(_P)]).alias("all_centre"),
        F.array(*[F.col(f"of.cov{i}") for i in range(len(_PAIRS))]).alias("all_cov"))
    return settle(both.mapInPandas(lambda it: _pooled(it, rules), "lang string, source string, centre array<double>, cov array<double>, inverse array<double>"), "estimates")


def _order(column: str | None):
    from pyspark.sql import Window

    group = Window.partitionBy(*_GROUP, "start")
    return group.orderBy(column).rowsBetween(Window.unboundedPreceding, 0) if column else group


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their group's centre and covariance to squared distances, each text's sampling error included; null where the base rules fail."""
    names = ["doc_id", "row_key", *_COUNTS, "base_failed"]
    for batch in batches:
        rows = np.flatnonzero(~batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool))
        part = batch.take(pa.array(rows))
        distance = np.full(batch.num_rows, np.nan)
        if len(rows):
            x, centre, upper = (part.column(c).flatten().to_numpy().reshape(len(rows), -1) for c in ("x", "centre", "cov"))
            cov = np.zeros((len(rows), _P, _P))
            for k, (i, j) in enumerate(_PAIRS):
                cov[:, i, j] = cov[:, j, i] = upper[:, k]
            n, lines = (part.column(c).to_numpy().astype(float) for c in ("n_words", "n_lines"))
            cov[:, range(_P), range(_P)] += _sampling_variance(n, lines, centre)
            apart = x - centre
            distance[rows] = np.einsum("ni,ni->n", apart, np.linalg.solve(cov, apart[:, :, None])[:, :, 0])
        yield pa.record_batch([*[batch.column(c) for c in names], pa.array(distance, mask=np.isnan(distance))], [*names, "distance"])


def judge(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(doc_id, row_key, counts, base_failed, distance, kept) for every document.

    Documents that fail the base rules are not kept and take no part in the estimates: their ratios say little.  Null or
    empty texts have no words, so they fail.  Null languages and sources are groups of their own.  Texts of any length are counted whole, by one task.  ``distance`` is the squared
    distance from the group in units of the group's spread and the text's own sampling error, null for failed documents.  Repeated rows repeat their result, an empty table gives an empty one, and
    other columns are ignored.
    """
    counted = settle(text_counts(documents).withColumn("x", _vector()).withColumn("base_failed", base_failed()), "counts")
    fine = counted.where("not base_failed").select("lang", "source", "x")
    estimates = robust_estimates(fine, rules)
    e = estimates.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "centre", "cov")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    placed = counted.join(e, same, "left")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    done = placed.select("doc_id", "row_key", *_COUNTS, "base_failed", "x", "centre", "cov").mapInArrow(
        _judged, f"doc_id {id_type}, row_key string, {counts}, base_failed boolean, distance double")
    return done.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= rules.cutoff))


def good_documents(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept documents, as they were."""
    bad = judge(documents, rules).where("not kept").select(F.col("row_key").alias("__key")).distinct()
    return documents.join(bad, row_digest(documents["doc_id"], documents["text"]) == bad["__key"], "left_anti")
