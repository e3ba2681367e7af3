"""Packing, resampling and hard negatives against plain Python, and their edge cases."""

import math
import os
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wayfleet.llm import lengths, negatives, packing, resampling, tokens

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def whole_encoding():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


# --- token ids ------------------------------------------------------------------------

def test_pieces_encode_as_the_whole_text():
    """Random texts of white space, controls, marks, contractions and special strings; and every assigned plane's code points."""
    whole, encoder = whole_encoding(), tokens.Encoder(tokens.read_vocabulary())
    draw = random.Random(1)
    parts = [*" \n\t\r\x0b\x1c\x85\xa0 　​᠎ab1'!é中́", "<|endoftext|>", "'s", "'ll", "  "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    texts += [f"a{chr(c)}b {chr(c)}\n{chr(c)}{chr(c)}  {chr(c)}1" for c in range(0, 0x30000, 23) if not 0xD800 <= c < 0xE000]
    long = [" " * 12_000 + "a", "b" + "\n" * 10_001, f"x {' ' * 10_000}<|endoftext|>\ny"]
    assert [encoder.ids(t).tolist() for t in texts + long] == [e.ids for e in whole.encode_batch(texts + long, add_special_tokens=False)]
    whole.encode_special_tokens = True
    plain = tokens.Encoder(tokens.read_vocabulary(), special=False)
    assert [plain.ids(t).tolist() for t in texts + long] == [e.ids for e in whole.encode_batch(texts + long, add_special_tokens=False)]


def test_token_lengths_of_long_runs(spark):
    """Five million blanks, line ends and tabs, and 25 million characters of words, are counted like any text."""
    texts = [" " * 5_000_000, "\n" * 5_000_000 + "x", "\t" * 1_200_000, "word " * 5_000_000, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6, "doc_id")
    got = {r.doc_id: r.n_tokens for r in lengths.token_lengths(docs).collect()}
    tabs = len(whole_encoding().encode(texts[2], add_special_tokens=False).ids)
    assert got == {0: 5_000_000, 1: 2_500_002, 2: tabs, 3: 5_000_001, 4: 0, 5: 0}


# --- packing --------------------------------------------------------------------------

def check_packed(rows, capacity):
    """Every sequence is filled from 0 without a gap and not above its length; gives their number."""
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for of in held.values():
        at = 0
        for offset, length in sorted(of):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(held)


@needs_tables
def test_packing_query(spark):
    whole = whole_encoding()
    want, sizes = {}, []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 2]
        cut, piece, start = len(ids) % 1024 or 1024, 0, 0
        sizes.append(cut)
        while start < len(ids):
            part = ids[start:cut]
            want[r.doc_id, piece] = (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            piece, start, cut = piece + 1, cut, cut + 1024
    got = entry.queries()["op11_best_fit_packing"](spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    n_sequences = check_packed(got, 1024)
    bins, room = [-1] * len(sizes), []
    packing.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, bins, room, 1024)
    full = sum(n == 1024 for n in sizes)
    assert n_sequences <= len(room) - full + full + len(want) - len(sizes)


def test_best_fit_takes_the_tightest_bin():
    draw = random.Random(3)
    lengths = [draw.randint(1, 100) for _ in range(400)]
    bins, room = [-1] * 400, []
    packing.best_fit(list(range(400)), lengths, bins, room, 100)
    free = []
    for i, n in enumerate(lengths):
        fitting = [r for r in free if r >= n]
        if fitting:
            free[free.index(min(fitting))] -= n
        else:
            free.append(100 - n)
    assert sorted(free) == sorted(room)


def test_children_are_whole_packings():
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.integers(1, 100, 300))
    one, (n_one, _) = packing.evolve(lengths, 100, rng, [], 3, 0, 0)
    other = packing.mutated(one, lengths, 100, rng, 0.6)
    child = packing.crossed(one, other, lengths, 100, rng)
    for bins in (one, other, child):
        assert bins.min() == 0 and np.bincount(bins, weights=lengths).max() <= 100 and len(np.unique(bins)) == bins.max() + 1
    # The child holds some whole bins of the one that gave them, as they were.
    sets = lambda bins: {frozenset(np.flatnonzero(bins == b).tolist()) for b in range(bins.max() + 1)}
    assert sets(child) & sets(other)
    # Halves that fit each other exactly are found: 60 pieces, 30 bins.
    halves = np.sort(np.concatenate([np.arange(20, 50), 100 - np.arange(20, 50)]))
    best, (n_bins, _) = packing.evolve(halves, 100, rng, [], 4, 4, 4)
    assert n_bins == 30


def test_many_shards_and_islands(spark):
    """Several rounds over shards of 60 pieces: each piece once, near the least number of sequences; a second run gives the same."""
    draw = random.Random(4)
    rows = [(i, draw.choice([draw.randint(1, 128), 128])) for i in range(1200)]
    frame = spark.createDataFrame(rows, "no long, length long")
    options = {"capacity": 128, "shard_pieces": 60, "islands": 2, "population": 3, "children": 2, "generations": 2}
    got = packing.pack_lengths(frame, **options).join(frame, "no").collect()
    assert sorted(r.no for r in got) == list(range(1200))
    n_sequences, least = check_packed(got, 128), -(-sum(n for _, n in rows) // 128)
    assert n_sequences <= 1.02 * least + 1
    again = packing.pack_lengths(frame, **options).collect()
    assert sorted((r.no, r.sequence_id, r.offset) for r in again) == sorted((r.no, r.sequence_id, r.offset) for r in got)


def test_packing_edges(spark):
    """Null and empty texts, a very long one, equal rows, null ids, clashing columns, nothing at all."""
    long = "word " * 60_000
    schema = "doc_id long, text string, row string, piece int, sequence_id string, length string"
    rows = [(1, None), (2, ""), (2, ""), (None, "a b c"), (3, long), (4, " " * 30_000)]
    docs = spark.createDataFrame([(*r, "x", 7, "x", "x") for r in rows], schema)
    got = packing.pack(docs).collect()
    check_packed(got, 1024)
    assert [r.length for r in got if r.doc_id in (1, 2)] == [1, 1, 1]
    assert sum(r.length for r in got if r.doc_id == 3) == 1 + len(whole_encoding().encode(long, add_special_tokens=False).ids)
    held = {r.sequence_id: (r.length, len(r.ids)) for r in packing.sequences(packing.pack(docs)).collect()}
    assert len(held) == len({r.sequence_id for r in got}) and all(4 * n == size for n, size in held.values())
    assert packing.pack(docs.limit(0)).collect() == []


# --- resampling -----------------------------------------------------------------------

def resampled(docs, items, buckets=10_000):
    def runs(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [zlib.crc32(" ".join(words[p : p + k]).encode()) % buckets for k in (1, 2, 3) for p in range(len(words) - k + 1)]

    found, target = [runs(t) for _, t in docs], [runs(t) for t in items]
    s, t = [0] * buckets, [0] * buckets
    for counts, of in ((s, found), (t, target)):
        for _, listed in of:
            for b in listed:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for (doc_id, _), (n, listed) in zip(docs, found):
        h = int(sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in listed)
        rows.append([doc_id, n, len(listed), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(order[: 5 * len(order) // 100], 1):
        r[5] = place
    return sorted(map(tuple, rows), key=str)


def test_crc_of_runs_from_words():
    """Short and long words, one to three of them, against the CRC of the joined text."""
    draw = random.Random(2)
    words = ["x" * n for n in (1, 63, 64, 65, 200, 5000)] + ["".join(draw.choice("abé中") for _ in range(draw.randint(1, 90))) for _ in range(200)]
    draw.shuffle(words)
    text = "; ".join(words)
    splitter = resampling.Splitter()
    starts, ends = splitter.words(text)
    data = np.frombuffer(text.encode(), np.uint8)
    rows = np.arange(len(words)) // 50
    owners, found = resampling.run_buckets(data, starts, ends, rows, 1 << 31, 3)
    want = [(p // 50, zlib.crc32(" ".join(words[p : p + k]).encode()) % (1 << 31)) for k in (1, 2, 3) for p in range(len(words) - k + 1) if p // 50 == (p + k - 1) // 50]
    assert list(zip(owners.tolist(), found.tolist())) == want


def test_words_of_parts(monkeypatch):
    monkeypatch.setattr(resampling, "PART", 7)
    text = "ab cdefghijklmnop é中q. 12 x" * 5
    starts, ends = resampling.Splitter().words(text)
    raw = text.encode()
    assert [raw[a:b].decode() for a, b in zip(starts, ends)] == WORD.findall(text)


@needs_tables
def test_resampling_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = entry.queries()["op12_resampling"](spark, SF).collect()
    want = [(a, c, d, e, f) for a, _, c, d, e, f in resampled(docs, items)]
    assert sorted(((r.doc_id, r.n_features, r.weight, r["score"], r["rank"]) for r in got), key=str) == sorted(want, key=str)


def test_resampling_edges(spark):
    """Nulls, ties, equal rows by the hundred, a very long text, an empty target, no documents, clashing columns."""
    plain = " ".join(f"w{i}" for i in range(25))
    docs = [(None, None), (1, ""), (2, "only three words"), (3, plain), (3, plain), (None, plain), (4, "word " * 50_000), (5, "x" * 70_000 + " y" * 30)]
    docs += [(7, plain.upper())] * 200
    schema = "doc_id long, text string, row long, score string, rank int, runs string"
    frame = spark.createDataFrame([(*d, 1, "x", 1, "x") for d in docs], schema)
    for items in (["w1 w2 w3", None, "y y"], []):
        target = spark.createDataFrame([(t,) for t in items], "text string")
        got = resampling.resample(frame, target).collect()
        rows = sorted((tuple(r) for r in got), key=str)
        # Rows equal in id and score are interchangeable: compare without ranks, and the ranks by what they go to.
        want = resampled(docs, items)
        assert sorted((r[:5] for r in rows), key=str) == sorted((r[:5] for r in want), key=str)
        assert sorted((r[5], r[0], r[4]) for r in rows if r[5]) == sorted((r[5], r[0], r[4]) for r in want if r[5])
    assert resampling.resample(frame.limit(0), target).collect() == []


# --- hard negatives -------------------------------------------------------------------

def mined(rows, query, most=5, few=3, low=50, high=95):
    """rows: (id, label, vector); ``query`` tells anchors by id."""
    fine = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, lab, v) in enumerate(fine):
        if i is None or not query(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, other) for m, (j, other, w) in enumerate(fine) if m != n), key=lambda x: x[:3])
        for s, none, j, _ in [x for x in scored if x[3] == lab][:most]:
            fit = [x for x in scored if x[3] != lab and low * -s <= 100 * -x[0] <= high * -s][:few]
            out += [(i, None if none else j, rank, None if x[1] else x[2], -s, -x[0]) for rank, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def test_table_scores_are_inner_products():
    rng = np.random.default_rng(7)
    for low, high, dims in ((-160, 160, 64), (0, 1, 8), (-1, 0, 16), (-(1 << 27), 1 << 27, 24), (5, 6, 8)):
        rows, anchors = rng.integers(low, high, (50, dims)), rng.integers(low, high, (9, dims))
        bits = negatives.pack_bits(rows)
        tables = negatives.subset_sums(anchors, negatives._narrow(anchors, len(bits)))
        assert (negatives.table_scores(tables, bits) == rows @ anchors.T).all()


@pytest.mark.parametrize("seed, blocks", [(1, (2048, 512)), (2, (7, 3)), (3, (16, 100))])
def test_mined_negatives(spark, seed, blocks):
    """Clustered vectors with ties, copies, holes, infinities and unequal lengths, in large and in very small blocks."""
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(300):
        label = draw.randrange(4)
        vector = [round((c + draw.gauss(0, 1)) * 4) / 16 for c in centres[draw.choice([label, 0])]][: draw.choice([12, 12, 12, 5])]
        rows.append((i, label, vector))
    rows += [rows[10], rows[10], rows[50], (None, 1, rows[3][2]), (None, 2, rows[3][2])]
    rows += [(400, None, [1.0]), (450, 1, None), (500, 1, [1.0, None]), (550, 1, [float("nan")]), (600, 1, [float("inf")]), (650, 1, []), (700, 9, [1.0] * 12)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, no string, score int")
    got = negatives.mine(frame, F.col("vec_id") % 50 == 0, candidate_rows=blocks[0], anchor_rows=blocks[1])
    assert sorted(map(tuple, got.collect()), key=str) == mined(rows, lambda i: i % 50 == 0)


def test_negatives_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<double>")
    assert negatives.mine(empty, F.col("vec_id") % 50 == 0).collect() == []
    # Huge components are cut, not lost; a lone anchor without positives gives nothing.
    rows = [(0, 0, [1e30, 0.0]), (1, 0, [1e30, -1e30]), (2, 1, [1e5, 0.0]), (3, 1, [0.9 * 2**19, 0.0]), (50, 2, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, empty.schema)
    got = negatives.mine(frame, F.col("vec_id") % 50 == 0).collect()
    cut = negatives.LARGEST
    assert [(r.anchor_id, r.positive_id, r.negative_id, r.positive_score) for r in got] == [(0, 1, 3, cut * cut)]


def test_query_plans_have_no_cross_join(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    for name in ("op11_best_fit_packing", "op12_resampling", "op13_hard_negatives"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
