"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posteriors.

Voters are hand-written lexicons and patterns, and lexicons of words and word beginnings that a bounded
sample of labelled documents ties to toxic text.  The label model is a tree-augmented mixture: given the
hidden label, each voter depends on one other voter, its most correlated one, so agreement between voters that copy each
other is not counted twice.  Its accuracies and correlations are fitted by expectation-maximisation to the vote
patterns of all documents; labels that are known anchor it, and a few made-up documents in which hand-written voters
mostly vote where text is toxic, so that its two classes mean the same without any label.  A logistic classifier over the mined
words and the votes is then trained on the posterior labels of a bounded sample of all documents, labelled or not, and scores every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import bounded_batches, hash_share, row_digest, settle

# Insulting, hateful, threatening and vulgar words by language, written by hand.
LEXICONS = {
    "insult_en": "idiot idiots stupid moron morons imbecile loser losers clown dumb dumbass fool jerk pathetic worthless",
    "contempt_en": "trash garbage scum vermin filth disgusting vile subhuman parasite parasites pig pigs rat rats",
    "vulgar_en": "damn crap shit shitty bullshit fuck fucking fucker asshole bastard bitch whore slut piss",
    "threat_en": "kill murder slaughter hang shoot strangle stab exterminate die",
    "insult_de": "idiot idioten dumm dummkopf trottel depp versager blödmann schwachkopf arschloch wertlos erbärmlich",
    "vulgar_de": "scheiße scheiss verdammt fick ficken hure schlampe abschaum dreck drecksau widerlich",
    "insult_fr": "idiot idiote imbécile crétin crétine débile stupide connard connasse minable pathétique abruti",
    "vulgar_fr": "merde putain salope enculé ordure ordures racaille dégoûtant nique foutre",
    "insult_es": "idiota idiotas estúpido estúpida imbécil tonto payaso inútil patético fracasado cretino",
    "vulgar_es": "mierda puta puto cabrón gilipollas joder escoria basura asqueroso coño",
}
# Patterns over lower-cased text, each with the pieces of text one of which any match contains.
PATTERNS = {
    "you_are": (
        r"\b(?:you|u)(?: are|'re|r| all)? (?:a |an |such |so |all |just |nothing )*(?:idiot|stupid|dumb|moron|loser|trash|pathetic|worthless|disgusting|scum|clown)",
        "idiot stupid dumb moron loser trash pathetic worthless disgusting scum clown"),
    "go_away": (
        r"\b(?:shut up|go to hell|drop dead|get lost|kill yourself|kys|screw you|f[*u]ck (?:you|off))\b",
        "shut hell dead lost yourself kys screw fuck f*ck"),
    "masked": (r"\b[fsbca][*@#$!]{2,}[a-z]*\b|\bf\*+\w*|\bs\*+t\b", "* @ # $ !"),
    "nobody": (r"\b(?:nobody|no one) (?:likes|loves|wants|cares about) (?:you|them|him|her)\b", "likes loves wants cares"),
    "hate": (r"\b(?:i|we) (?:hate|despise|loathe) (?:you|them|those|these|all)\b", "hate despise loathe"),
}

WORD = r"[^\W\d_]+"


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled documents to mine words from and to train on, on average, chosen by a hash of their ids; the rest of the corpus still
    counts for the label model.  ``words``: mined features kept, at most.  ``mined_voters``: lexicons the mined words are dealt to.
    ``stems``: lengths of word beginnings that are mined beside whole words.  ``least_docs``: toxic documents a mined word must be in.
    ``rounds``: steps of expectation-maximisation.  ``trust``: probability that a known label is right."""

    sample: int = 20_000
    words: int = 2048
    mined_voters: int = 12
    stems: tuple[int, ...] = (4, 5, 6)
    least_docs: int = 5
    rounds: int = 8
    trust: float = 0.97
    penalty: float = 1e-3
    # Weight in training of all documents without a label, as a share of that of the labelled ones.
    unlabelled: float = 0.25
    # Without any label, posteriors of toxic text weigh this share of the sample at least, so that the penalty does not outweigh a few.
    least_toxic: float = 0.1


def _training_ids(labels: DataFrame, learn: Column, settings: Settings) -> DataFrame:
    """(doc_id, toxic) of the sample; ids with contradicting labels count as toxic."""
    known = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, settings.sample / max(1, known.count()))
    return known.where(hash_share(F.col("doc_id")) < share)


def _mine(sample: DataFrame, settings: Settings) -> list[tuple[str, float]]:
    """(feature, log odds) of the words and word beginnings that toxic documents of the sample have more often; ``w:`` and ``s:`` tell them apart."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    stems = [F.transform(F.filter("words", lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.lit("s:"), F.substring(w, 1, n))) for n in settings.stems]
    listed = sample.where("text is not null").select("toxic", words.alias("words")).select(
        "toxic", F.array_distinct(F.concat(F.transform(F.filter("words", lambda w: F.length(w) > 1), lambda w: F.concat(F.lit("w:"), w)), *stems)).alias("features"))
    listed = settle(listed, "features")
    base = listed.agg(F.sum("toxic").alias("p"), F.count(F.lit(1)).alias("n")).first()
    p, n = float(base["p"] or 0), float(base["n"])
    if p == 0 or p == n:
        return []
    counted = listed.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("toxic").alias("p"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("p") + 0.5) / (p + 1)) - F.log((F.col("n") - F.col("p") + 0.5) / (n - p + 1))
    spread = F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") - F.col("p") + 0.5))
    best = counted.where(F.col("p") >= settings.least_docs).withColumn("odds", odds).withColumn("z", F.col("odds") / spread)
    best = best.where("odds > 1 and z > 3").orderBy(F.col("z").desc(), "feature").limit(settings.words)
    return [(r["feature"], float(r["odds"])) for r in best.collect()]


HAND_WRITTEN = len(LEXICONS) + len(PATTERNS)


@dataclass(frozen=True)
class Features:
    """What a task needs to read a text: mined words by place, and the voters."""

    words: dict[str, int]
    stems: dict[str, int]
    stem_lengths: tuple[int, ...]
    voter_of: np.ndarray
    n_mined_voters: int

    @property
    def n_voters(self) -> int:
        return HAND_WRITTEN + self.n_mined_voters + 2


def _features(mined: list[tuple[str, float]], settings: Settings) -> Features:
    words = {f[2:]: i for i, (f, _) in enumerate(mined) if f.startswith("w:")}
    stems = {f[2:]: i for i, (f, _) in enumerate(mined) if f.startswith("s:")}
    # Neighbours in strength go to different voters, so that each has strong and weak words.
    voter_of = np.array([i % settings.mined_voters for i in range(len(mined))], np.int64)
    return Features(words, stems, settings.stems, voter_of, settings.mined_voters)


def _read(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Votes as bits of a number, and the places and counts of mined words."""
    f: Features = shared.value
    word = re.compile(WORD)
    lexicons = [frozenset(v.split()) for v in LEXICONS.values()]
    patterns = [(re.compile(p), pieces.split()) for p, pieces in PATTERNS.values()]
    first_mined = len(lexicons) + len(patterns)
    any_insult = frozenset().union(*lexicons)
    for batch in batches:
        votes, places, counts = [], [], []
        for value in batch.column("text"):
            low = (value.as_py() or "").lower()
            found: dict[int, int] = {}
            seen: dict[str, int] = {}
            for w in word.findall(low):
                seen[w] = seen.get(w, 0) + 1
            for w, n in seen.items():
                i = f.words.get(w)
                if i is not None:
                    found[i] = found.get(i, 0) + n
                for k in f.stem_lengths:
                    if len(w) > k:
                        i = f.stems.get(w[:k])
                        if i is not None:
                            found[i] = found.get(i, 0) + n
            bits = 0
            named = any_insult & seen.keys()
            for v, lexicon in enumerate(lexicons):
                bits |= (not lexicon.isdisjoint(named)) << v
            for v, (pattern, pieces) in enumerate(patterns):
                if any(piece in low for piece in pieces):
                    bits |= (pattern.search(low) is not None) << (len(lexicons) + v)
            for i in found:
                bits |= 1 << (first_mined + int(f.voter_of[i]))
            # Two voters on how much there is: several different words, and a high share of them.
            bits |= (len(found) >= 3) << (first_mined + f.n_mined_voters)
            bits |= (sum(found.values()) * 50 >= max(1, sum(seen.values()))) << (first_mined + f.n_mined_voters + 1)
            votes.append(bits)
            places.append(sorted(found))
            counts.append([found[i] for i in sorted(found)])
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch(
            [*[batch.column(n) for n in rest], pa.array(votes, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
            [*rest, "votes", "places", "counts"])


@dataclass(frozen=True)
class LabelModel:
    """``prior``: share of toxic documents.  ``parent``: the voter each voter leans on, -1 for none.  ``fires[v, y, u]``: probability that
    voter v votes, given label y and the vote u of its parent (without one, both u are alike)."""

    prior: float
    parent: np.ndarray
    fires: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Of toxic against not, for rows of votes as 0 and 1."""
        out = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for v, u in enumerate(self.parent):
            given = votes[:, u] if u >= 0 else np.zeros(len(votes), np.int64)
            yes, no = self.fires[v, 1][given], self.fires[v, 0][given]
            out += np.where(votes[:, v] > 0, np.log(yes / no), np.log((1 - yes) / (1 - no)))
        return out


def _bits(numbers: np.ndarray, voters: int) -> np.ndarray:
    return (numbers[:, None] >> np.arange(voters)) & 1


def _pair_counts(batches: Iterator[pa.RecordBatch], voters: int, shared, trust: float) -> Iterator[pa.RecordBatch]:
    """Expected numbers of (label, vote v, vote u) in a task, as one row: the E-step, and all that the M-step needs."""
    total = np.zeros((2, voters + 1, voters + 1))
    for batch in batches:
        numbers, known, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        votes = _bits(numbers.astype(np.int64), voters)
        known = known.astype(float)
        model: LabelModel | None = shared.value
        if model is None:
            # To begin with, the number of hand-written voters that vote stands for the probability.
            p = np.array([0.02, 0.6, 0.95])[np.minimum(votes[:, :HAND_WRITTEN].sum(axis=1), 2)]
        else:
            p = 1 / (1 + np.exp(-np.clip(model.log_odds(votes), -30, 30)))
        p = np.where(np.isnan(known), p, np.where(known > 0, trust, 1 - trust))
        rows = np.column_stack([np.ones(len(votes)), votes])
        for y, weight in ((0, (1 - p) * n), (1, p * n)):
            total[y] += (rows * weight[:, None]).T @ rows
    yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "value"])


def _fit_tree(total: np.ndarray) -> LabelModel:
    """M-step: the tree of strongest conditional mutual information, and its tables.  ``total[y, v, u]`` counts joint votes; place 0 stands for all."""
    v = total.shape[1] - 1
    weight = total[:, 0, 0]
    prior = float(np.clip(weight[1] / max(weight.sum(), 1.0), 1e-3, 1 - 1e-3))
    one = total[:, 0, 1:]
    gain = np.zeros((v, v))
    for y in (0, 1):
        both = total[y, 1:, 1:]
        w = weight[y] + 4.0
        a, b = one[y][:, None] + 2.0, one[y][None, :] + 2.0
        for joint, x, z in ((both + 1, a, b), (one[y][:, None] - both + 1, a, w - b), (one[y][None, :] - both + 1, w - a, b), (weight[y] - one[y][:, None] - one[y][None, :] + both + 1, w - a, w - b)):
            joint = np.maximum(joint, 1e-9)
            gain += joint * np.log(joint * w / (x * z))
    np.fill_diagonal(gain, -np.inf)
    parent, inside = np.full(v, -1), [0]
    while len(inside) < v:
        rest = [i for i in range(v) if i not in inside]
        sub = gain[np.ix_(inside, rest)]
        i, j = np.unravel_index(sub.argmax(), sub.shape)
        parent[rest[j]] = inside[i]
        inside.append(rest[j])
    fires = np.zeros((v, 2, 2))
    for k in range(v):
        for y in (0, 1):
            alone = (one[y, k] + 1.0) / (weight[y] + 2.0)
            if parent[k] < 0:
                fires[k, y] = alone
            else:
                u = parent[k]
                joint = total[y, 1 + k, 1 + u]
                # Shrunk towards the voter's own rate where the parent seldom votes.
                fires[k, y, 1] = (joint + 4 * alone) / (one[y, u] + 4)
                fires[k, y, 0] = (one[y, k] - joint + 4 * alone) / (weight[y] - one[y, u] + 4)
    return LabelModel(prior, parent, np.clip(fires, 1e-4, 1 - 1e-4))


def _made_up(voters: int) -> np.ndarray:
    """Counts of a hundred made-up documents, ten of them toxic: voters are independent, and hand-written ones vote on toxic text."""
    total = np.zeros((2, voters + 1, voters + 1))
    for y, (n, rate) in enumerate(((90.0, 0.005), (10.0, 0.25))):
        fires = np.full(voters + 1, 0.005)
        fires[1 : HAND_WRITTEN + 1], fires[0] = rate, 1.0
        total[y] = n * np.outer(fires, fires)
        np.fill_diagonal(total[y], n * fires)
    return total


def fit_label_model(patterns: DataFrame, voters: int, settings: Settings) -> LabelModel:
    """From ``patterns`` (votes, known, n): vote patterns of all documents with their numbers.  A step sends one table of numbers per task."""
    spark = patterns.sparkSession
    model = None
    for _ in range(settings.rounds):
        shared = spark.sparkContext.broadcast(model)
        cells = patterns.mapInArrow(lambda it, s=shared: _pair_counts(it, voters, s, settings.trust), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
        total = np.zeros(2 * (voters + 1) ** 2)
        total[cells["cell"].to_numpy()] = cells["value"].to_numpy()
        model = _fit_tree(total.reshape(2, voters + 1, voters + 1) + _made_up(voters))
    return model


@dataclass(frozen=True)
class Classifier:
    features: Features
    label_model: LabelModel
    weights: np.ndarray
    bias: float


def _dense(places: list, counts: list, votes: np.ndarray, features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row, column, value): damped counts of mined words, then the votes."""
    sizes = [len(p) for p in places]
    rows = np.repeat(np.arange(len(places)), sizes)
    columns = np.array([i for p in places for i in p], np.int64)
    values = np.log1p(np.array([c for x in counts for c in x], float))
    r, c = np.nonzero(_bits(votes, features.n_voters))
    return np.concatenate([rows, r]), np.concatenate([columns, len(features.voter_of) + c]), np.concatenate([values, np.ones(len(r))])


def _fit_linear(rows: DataFrame, features: Features, settings: Settings) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels.  ``rows`` is the bounded sample, equal rows as one with a weight, so its sparse rows fit a Newton-like solver on the driver in a few megabytes."""
    frame = rows.toPandas()
    r, c, v = _dense(list(frame["places"]), list(frame["counts"]), frame["votes"].to_numpy(np.int64), features)
    q, width = frame["posterior"].to_numpy(float), len(features.voter_of) + features.n_voters
    if not len(q):
        return np.zeros(width), -2.0
    share = frame["weight"].to_numpy(float)
    share /= share.sum()
    if not frame["known"].any() and 0 < share @ q < settings.least_toxic:
        share = share * (1 - q + q * settings.least_toxic / (share @ q))
        share /= share.sum()
    n, mean = len(q), float(share @ q)
    w, b = np.zeros(width), float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
    # Accelerated proximal steps per coordinate: step sizes from the diagonal bound of the curvature.
    bound = 0.25 * np.bincount(c, weights=v * share[r] * np.bincount(r, weights=v, minlength=n)[r], minlength=width) + settings.penalty
    look_w, look_b, t = w.copy(), b, 1.0
    for _ in range(400):
        z = np.bincount(r, weights=look_w[c] * v, minlength=n) + look_b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - q) * share
        g = np.bincount(c, weights=error[r] * v, minlength=width) + settings.penalty * look_w
        new_w, new_b = look_w - 0.5 * g / bound, look_b - 0.5 * error.sum() / 0.25
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w, look_b = new_w + (t - 1) / t_next * (new_w - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return w, b


def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    m: Classifier = shared.value
    for batch in batches:
        r, c, v = _dense(batch.column("places").to_pylist(), batch.column("counts").to_pylist(), batch.column("votes").to_numpy(), m.features)
        z = np.bincount(r, weights=m.weights[c] * v, minlength=batch.num_rows) + m.bias
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        posterior = 1 / (1 + np.exp(-np.clip(m.label_model.log_odds(_bits(batch.column("votes").to_numpy(), m.features.n_voters)), -30, 30)))
        yield pa.record_batch([batch.column("doc_id"), batch.column("row_key"), pa.array(score), pa.array(posterior)], ["doc_id", "row_key", "score", "posterior"])


def score(documents: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, row_key, score, posterior) for every whole text; labels are read where ``learn`` holds only.

    Null and empty texts have no votes and get the score of a text without any sign of toxicity.  Without a label to learn from
    the hand-written voters alone make the label model, and its posteriors train the classifier.  Repeated rows repeat their score;
    an id that very many rows share, or equal texts, weigh on the sample by their number but do not enlarge it; texts of any length are read
    whole; an empty table gives an empty result; other columns, and language and source, are never read.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    ids = settle(_training_ids(labels, learn, settings), "labels")
    # At most ``sample`` ids, so small enough to send to every task.
    chosen = ids.select(F.col("doc_id").alias("_id"), "toxic")
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("toxic", "text")
    features = _features(_mine(sample, settings), settings)

    given = spark.sparkContext.broadcast(features)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    keyed = documents.select("doc_id", row_digest(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    read = settle(keyed.mapInArrow(lambda it: _read(it, given), f"doc_id {id_type}, row_key string, votes long, places array<int>, counts array<int>"), "votes")
    known = read.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    patterns = settle(known.groupBy("votes", F.col("toxic").cast("double").alias("known")).agg(F.count(F.lit(1)).cast("double").alias("n")), "patterns")
    model = fit_label_model(patterns, features.n_voters, settings)

    weights, bias = _fit_linear(_training_rows(known, model, features, settings), features, settings)
    shared = spark.sparkContext.broadcast(Classifier(features, model, weights, bias))
    return read.mapInArrow(lambda it: _scored(it, shared), f"doc_id {id_type}, row_key string, score double, posterior double")


def _training_rows(known: DataFrame, model: LabelModel, features: Features, settings: Settings) -> DataFrame:
    """(places, counts, votes, posterior, weight) of the sample: about ``sample`` different texts with a label and as many without one.

    A hash of the row draws them.  Equal rows are one, with their number as weight; all rows without a label together weigh
    ``unlabelled`` times those with one, or all if none has one.
    """
    seen = known.agg(F.count_if(F.col("toxic").isNotNull()).alias("labelled"), F.count_if(F.col("toxic").isNull()).alias("others")).first()
    shares = {kind: min(1.0, settings.sample / max(1, seen[kind])) for kind in ("labelled", "others")}
    drawn = known.where(hash_share(F.col("row_key")) < F.when(F.col("toxic").isNotNull(), shares["labelled"]).otherwise(shares["others"]))
    rows = drawn.groupBy("places", "counts", "votes", "toxic").agg(F.count(F.lit(1)).cast("double").alias("n"))
    each = {"labelled": 1.0, "others": settings.unlabelled * (seen["labelled"] * shares["labelled"]) / max(1.0, seen["others"] * shares["others"]) if seen["labelled"] else 1.0}
    weight = F.col("n") * F.when(F.col("toxic").isNotNull(), each["labelled"]).otherwise(each["others"])
    rows = rows.select("places", "counts", "votes", F.col("toxic").cast("double").alias("toxic"), weight.alias("weight"))
    voters, trust = features.n_voters, settings.trust
    return rows.mapInArrow(lambda it: _posteriors(it, model, voters, trust), "places array<int>, counts array<int>, votes long, posterior double, weight double, known boolean")


def _posteriors(batches: Iterator[pa.RecordBatch], model: LabelModel, voters: int, trust: float) -> Iterator[pa.RecordBatch]:
    """Posterior labels: the label model's odds, times those of the label that a row carries, if any."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(float)
        given = np.where(np.isnan(toxic), 0.0, np.where(toxic > 0, 1.0, -1.0)) * np.log(trust / (1 - trust))
        odds = model.log_odds(_bits(batch.column("votes").to_numpy(), voters)) + given
        yield pa.record_batch(
            [batch.column("places"), batch.column("counts"), batch.column("votes"), pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30)))), batch.column("weight"), pa.array(~np.isnan(toxic))],
            ["places", "counts", "votes", "posterior", "weight", "known"])


def harmless_documents(documents: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> DataFrame:
    """The documents scored below 0.5, as they were."""
    bad = score(documents, labels, learn, settings).where("score >= 0.5").select(F.col("row_key").alias("__key")).distinct()
    return documents.join(bad, row_digest(documents["doc_id"], documents["text"]) == bad["__key"], "left_anti")
