"""Edge cases on small frames: nulls, empty and long texts, repeated rows, empty tables, extra columns."""

import hashlib
import base64
import random
import re

import pytest
from pyspark.sql import functions as F

from wayfleet.llm import chat, language, lengths, licenses, mixing, outliers, simhash, toxicity, warc, winnowing
from wayfleet.session import scratch

DOCS = "doc_id long, text string, lang string, source string, size long, taken string, row_key int, __key string, score int"
ROWS = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "b", 7, "x"),
    (2, None, None, None, None, None),
    (3, "", "en", "a", 0, ""),
    (4, "a " * 40000, "de", "b", 1, None),
    (4, "a " * 40000, "de", "b", 1, None),
    (None, "Mit License, one two", "fr", None, 2, "y"),
    (5, "\n \t", "en", "a", 3, "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, 1, "k", 2) for row in ROWS], DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=((1, 1, 0), (3, 1, 1), (4, 1, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_mixing(spark, docs, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
    taken = {}
    for r in got:
        taken.setdefault(r.source, [0, r.target, r.source_size])[0] += r.taken
    total = sum(v[2] for v in taken.values())
    assert {k: v[2] for k, v in taken.items()} == {"a": 0, "b": 11 + 80000, None: 4}
    assert all(v[0] == round(v[1]) for v in taken.values())
    assert sum(v[1] for v in taken.values()) == pytest.approx(total) or all(v[1] == 3 * v[2] for k, v in taken.items() if k != "b")
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    kept = mixing.mixed_documents(docs)
    assert set(docs.columns) < set(kept.columns) and kept.where("mix_taken <= 0").isEmpty()


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 1, "d": 5, "e": 90}, {"a": 0, "b": 3}, {"only": 12}])
def test_targets_against_resharing(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    total, capped = sum(sizes.values()), set()
    while True:
        left, shares = total - sum(3 * sizes[s] for s in capped), sum(w for s, w in weight.items() if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else weight[s] * left / shares for s in sizes}
        above = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    assert got == pytest.approx(target)


def test_archive(spark):
    pages = spark.createDataFrame(
        [(1, "http://a", "<p>x</p>", 5), (2, "http://b\r\nX: y", "<p>x</p>", 6), (3, None, None, 7), (4, "u", "", 8), (None, "n", "é", 9), (2, "http://b", "<p>x</p>", 1)],
        "page_id long, url string, html string, payload long")
    path = scratch(spark, "test-warc")
    warc.store(pages, path)
    got = warc.records(spark, path).collect()
    assert len(got) == 6 and all(r.intact for r in got)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got)
    assert kinds == [(0, "response", None), (1, "revisit", 2), (2, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]
    for r in got:
        body = bytes(r.payload)
        assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        head = bytes(r.head)
        stated = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        whole = head + (b"" if r.record_type == "revisit" else body)
        assert len(whole) - whole.index(b"\r\n\r\n") - 4 == stated
    ids = {r.record_id for r in got}
    assert all(r.head.decode().split("WARC-Refers-To: ")[1].split("\r\n")[0] in ids for r in got if r.record_type == "revisit" and r.refers_to == 4)
    files = scratch(spark, "test-warc-files")
    warc.export(warc.records(spark, path), files)
    text = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(f"{files}/*.txt").select("content").collect())
    assert text.count(b"WARC/1.1\r\n") == 6
    at = 0
    while at < len(text):
        end = text.index(b"\r\n\r\n", at) + 4
        at = end + int(text[at:end].split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert text[at : at + 4] == b"\r\n\r\n"
        at += 4
    warc.store(pages.limit(0), path)
    assert warc.records(spark, path).count() == 0


def test_winnowing(spark, docs, nothing):
    bench = spark.createDataFrame(
        [(10, "TWO, three; four five six seven eight nine ten eleven", "q"), (2, "license one", "r"), (3, None, "s"), (None, "two", "t"), (10, "one two three", "u"), (7, "!!", "v")],
        "item_id long, text string, n_words string")
    got = {(r.doc_id, r.n_words): r for r in winnowing.decontaminate(docs, bench).collect()}
    assert got[(1, 11)].n_hit == 11 and got[(1, 11)]["items"] == ["10"]
    assert got[(None, 4)].n_hit == 3 and got[(None, 4)]["items"] == ["2"]
    assert got[(2, 0)].n_hit == 0 and got[(4, 40000)].n_items == 0
    assert winnowing.decontaminate(docs, bench).count() == len(ROWS)
    assert winnowing.decontaminate(nothing, bench).count() == 0
    assert winnowing.decontaminate(docs, bench.limit(0)).where("n_hit > 0").isEmpty()
    assert sorted(r.doc_id or 0 for r in winnowing.clean_documents(docs, bench).collect()) == [2, 3, 4, 4, 5]
    assert winnowing.clean_documents(docs, bench).columns == docs.columns


def test_lengths(spark, docs, nothing):
    pytest.importorskip("tiktoken")
    per_doc = lengths.token_lengths(docs)
    counts = sorted(r.n_tokens for r in per_doc.collect())
    hist = lengths.length_histogram(per_doc, per_block=2)
    rows = {r.length: r for r in hist.collect()}
    for n in set(counts):
        r = rows[n]
        assert r.n_docs == counts.count(n) and r.tokens_longer == sum(c for c in counts if c > n)
        assert r.docs_upto == sum(c <= n for c in counts) and r.tokens_truncated == sum(min(c, n) for c in counts)
    limits = {r.context_limit: r for r in lengths.totals_at(hist, [0, 5, 10**6]).collect()}
    for limit, r in limits.items():
        assert r.tokens_kept == sum(min(c, limit) for c in counts) and r.docs_cut == sum(c > limit for c in counts)
    assert {r.share: r.length for r in lengths.quantile_lengths(hist, [0.5, 1.0]).collect()} == {0.5: counts[(len(counts) + 1) // 2 - 1], 1.0: counts[-1]}
    assert lengths.length_histogram(lengths.token_lengths(nothing)).count() == 0


def test_language(spark, docs, nothing):
    learn = F.lit(True)
    model = language.train(docs, learn)
    assert model.languages == ["de", "en"] or model.languages == ["de", "en", "fr"]
    got = language.identify(docs, model).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (2, 3, 5)) and 0 <= r.score <= 1
    assert language.train(nothing, learn) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(nothing, model).count() == 0
    one = language.train(docs.where("lang = 'en'"), learn)
    assert {r.lang_pred for r in language.identify(docs, one).collect()} <= {"en", "und"}


def test_codewords_differ():
    for k in (2, 3, 4, 5, 9, 40):
        codes = language.codewords([str(i) for i in range(k)], 31)
        apart = [(codes[i] != codes[j]).sum() for i in range(k) for j in range(i)]
        assert min(apart) >= (1 if k < 4 else 4)


def test_licenses(spark, docs, nothing):
    rows = [(1, "MIT-License mit  license"), (2, "the GNU Lesser General Public License v2.1"), (3, None), (4, "permit license"), (5, "SPDX-License-Identifier: Apache-2.0"), (6, "émit license")]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].labels) == (4, 2, 0, 2, "mit", "mit")
    assert (got[2].n_base, got[2].first_word, got[2].base_labels, got[2].labels) == (1, 3, "gpl", "gpl,lgpl")
    assert (got[3].n_words, got[3].n_base, got[3].first_word, got[3].base_labels, got[3].labels, got[3].score) == (0, 0, None, "", "", 0.0)
    assert got[4].n_base == 0 and got[6].n_base == 0
    assert got[5].labels == "apache" and got[5].base_labels == "" and got[5].score == 1.0
    assert 200 < len(licenses.rules()) < 999
    assert licenses.scan_licenses(docs).count() == len(ROWS) and licenses.scan_licenses(nothing).count() == 0


def matches_of(parsed):
    """Texts that a parsed pattern matches: every alternative, options with and without, white space as line breaks."""
    out = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            kinds = [(str(k), v) for k, v in value]
            if kinds[0][0] == "NEGATE":
                more = ["x"]
            else:
                more = [{"LITERAL": lambda v: chr(v), "RANGE": lambda v: chr(v[0]), "CATEGORY": lambda v: "\n"}[kinds[0][0]](kinds[0][1])]
        elif name == "NOT_LITERAL":
            more = ["x"]
        elif name == "BRANCH":
            more = [t for one in value[1] for t in matches_of(one)]
        elif name == "SUBPATTERN":
            more = matches_of(value[3])
        elif name == "MAX_REPEAT":
            low, high, inner = value
            more = [t * max(low, 1) for t in matches_of(inner)] + [""] * (low == 0)
        else:
            assert name == "ASSERT_NOT" or name == "AT", name
            more = [""]
        out = [a + b for a in out for b in more]
    return out


def test_license_gates_let_every_match_through(monkeypatch):
    texts = [b"\n" + t.encode() + b"\n" for r in licenses.rules() for t in matches_of(re._parser.parse(r.pattern.pattern.decode()))]
    assert len(texts) > 1000
    gated, first_gate = [licenses.detections(t) for t in texts], licenses.FIRST_GATE
    everything = tuple(((b"",), (r,)) for r in licenses.rules())
    monkeypatch.setattr(licenses, "FIRST_GATE", (b"",))
    monkeypatch.setattr(licenses, "_gates", lambda: everything)
    sample = random.Random(2).sample(range(len(texts)), 1000)
    for n in sample:
        assert gated[n] == licenses.detections(texts[n]), texts[n]
    for r in licenses.rules():
        for t in matches_of(re._parser.parse(r.pattern.pattern.decode())):
            folded = b" ".join(t.encode().split())
            assert r.pattern.search(b"\n" + t.encode() + b"\n") and any(k in folded for k in r.keywords), (r, t)
            assert any(w in folded for w in first_gate), (r, t)


@pytest.mark.parametrize("text, label", [
    (b"redistribution and\nuse in source and binary forms with or without\nmodification are permitted", "bsd"),
    (b"released into the public\ndomain", "public-domain"),
    (b"creative\ncommons attribution 4.0 license", "cc-by"),
    (b"under the psf license", "python"),
])
def test_licenses_in_wrapped_text(text, label):
    assert label in {r.label for _, _, r in licenses.detections(text)}


def test_containment_suppression():
    text = b"licensed under the gnu lesser general public license version 2.1"
    found = licenses.detections(text)
    assert {r.label for _, _, r in found} == {"lgpl"}
    for b, e, r in found:
        assert not any((x, y) != (b, e) and x <= b and e <= y and q.priority <= r.priority for x, y, q in found)


def test_simhash(spark, docs, nothing):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.row_key): r for r in got}
    empty = [r for r in got if r.print == 0]
    assert {r.doc_id for r in empty} == {2, 3, 5} and {r.component_id for r in empty} == {2}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert len(by) == len(ROWS) - 1
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4]


def test_quality(spark, docs, nothing):
    got = {(r.doc_id, r.n_words): r for r in outliers.judge(docs).collect()}
    assert all(not r.kept for r in got.values())
    r = got[(4, 40000)]
    assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (40000, 0, 0, 40000)
    assert outliers.judge(docs).count() == len(ROWS) and outliers.judge(nothing).count() == 0
    assert outliers.good_documents(docs).count() == 0


def test_quality_rejects_each_kind_of_outlier(spark):
    """With the rules as they are used: half the lines repeated, ten symbols in a hundred words, nearly half the words repeated, words of odd length."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(3000)]
    line = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    rows = [(n, "\n".join(line(draw.randint(5, 25)) for _ in range(draw.randint(11, 30))), "en", f"s{n % 2}") for n in range(400)]
    once = [line(2) for n in range(20)]
    again = draw.sample(once, 20)
    passage = line(45)
    rows += [
        (1000, "\n".join([*once, *again]), "en", "s0"),
        (1001, " ".join(line(9) + " #" for _ in range(12)), "en", "s0"),
        (1002, f"{passage} {line(60)} {passage} {line(60)}", "en", "s0"),
        (1003, " ".join(draw.choice(vocabulary) + draw.choice(vocabulary) for _ in range(200)), "en", "s1"),
    ]
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [i for i in (1000, 1001, 1002, 1003) if got[i].kept] == []
    assert sum(not got[n].kept for n in range(400)) <= 2


def test_toxicity(spark, docs, nothing):
    everything = F.lit(True)
    got = toxicity.score(docs, labels(spark), everything).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, none, everything).count() == len(ROWS)
    assert toxicity.score(nothing, labels(spark), everything).count() == 0
    assert toxicity.harmless_documents(docs, none, everything).columns == docs.columns


def test_toxicity_without_labels(spark):
    """With no label at all plainly toxic texts are scored above one half and plain ones below, whether many or few are toxic, and one text repeated by the hundred moves neither."""
    plain = [f"the weather in town {i} was fine and the market opened at {i} with bread, apples and cheese" for i in range(300)]
    rude = ["you are a stupid idiot and a worthless loser", "shut up you pathetic moron, nobody likes you, idiot", "I will kill you, you disgusting piece of shit", "fucking asshole, you dumb bitch", "du bist ein dummer idiot, du versager"]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for texts in (plain + rude, plain + rude * 30, plain[:10] + rude):
        frame = spark.createDataFrame(list(enumerate(texts + [plain[0]] * 200)), "doc_id long, text string")
        got = {r.doc_id: r.score for r in toxicity.score(frame, none, F.lit(True)).collect()}
        assert min(got[i] for i, t in enumerate(texts) if t in rude) > 0.5 > max(got[i] for i, t in enumerate(texts) if t in plain)
    left = toxicity.harmless_documents(frame, none, F.lit(True))
    assert {r.text for r in left.collect()} == set(plain[:10])


def test_one_labelled_id_in_many_rows(spark):
    rows = [(1, f"you idiot number {i}") for i in range(400)] + [(i, f"a calm text {i}") for i in range(2, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(1, 1, 1), *[(i, 1, 0) for i in range(2, 40)]], "doc_id long, quality int, toxic int")
    got = toxicity.score(frame, known, F.lit(True), toxicity.Settings(sample=50)).collect()
    assert len(got) == len(rows) and min(r.score for r in got if r.doc_id == 1) > 0.5


def test_chat_layouts(spark):
    rows = [
        (1, '{"messages":[{"role":"user","content":"a </s> ␛1"},{"role":"assistant","content":null},{"role":null,"content":"n"},{"role":"to[ROLE]ol","content":""}]}'),
        (2, '{"output":"o","instruction":"i"}'), (3, '{"data":{"reply":{"text":"r"},"prompt":{"text":"[INST]"}}}'), (4, "no json"), (5, None),
        (6, '{"messages":[]}'), (7, '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}'), (8, '{"prompt":"p","completion":12.5}'), (9, '{"prompt":"p"}'),
    ]
    found = chat.canonical_turns(spark.createDataFrame(rows, "id int, record string"))
    kinds = {r.id: r.layout for r in found.collect()}
    assert kinds == {1: "messages", 2: "instruction", 3: "nested_prompt", 4: None, 5: None, 6: "messages", 7: "conversations", 8: "prompt_completion", 9: None}
    done = chat.format_turns(found, "id")
    back = {r.id: r for r in done.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.masked_texts(F.col("formatted"), F.col("loss_mask"))).collect()}
    want = {r.id: r.turns or [] for r in found.collect()}
    assert {i: [tuple(t) for t in r.turns or []] for i, r in back.items()} == {i: [tuple(t) for t in turns] for i, turns in want.items()}
    assert back[1].loss == [""] and back[3].loss == ["r"] and back[7].loss == ["g"] and back[8].loss == ["12.5"]
    assert {r.id: r.reason for r in found.collect() if r.reason} == {4: "unreadable", 5: "no_record", 9: "undeclared_layout"}
    assert all(back[i].formatted is None and back[i].loss_mask is None for i in (4, 5, 9)) and back[6].formatted == ""
    for r in (r for r in back.values() if r.formatted):
        body = r.formatted
        for span in r.loss_mask:
            assert not any(c in body[span.begin : span.begin + span.length] for c in chat.CONTROLS)


def test_typed_records(spark):
    """Typed columns of three layouts, one undeclared, one row without a record; equal keys stay apart; texts beyond the JSON parser's limit."""
    long = "ab[INST]" * 3_200_000
    rows = [(1, ("p", "c"), None, None), (1, ("q", None), None, None), (None, None, ([("gpt", long), ("human", "␛")],), None), (3, None, None, ("x",)), (4, None, None, None), (5, None, ([],), None)]
    schema = "k long, pair struct<completion:string,prompt:string>, said struct<conversations:array<struct<from:string,value:string>>>, other struct<prompt:string>"
    frame = spark.createDataFrame(rows, schema)
    turned = chat.typed_turns(frame, ["pair", "said", "other"])
    assert sorted((r.layout or "", r.reason or "") for r in turned.select("layout", "reason").collect()) == [
        ("", "no_record"), ("", "undeclared_layout"), ("conversations", ""), ("conversations", ""), ("prompt_completion", ""), ("prompt_completion", "")]
    back = chat.format_turns(turned, "k").withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.masked_texts(F.col("formatted"), F.col("loss_mask")))
    got = back.select("k", "loss", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), F.length(t["text"]).cast("string"))).alias("turns"), F.col("formatted").isNull().alias("unknown")).collect()
    assert sorted((r.k, r.turns) for r in got if r.k == 1) == [(1, ["user:0", "assistant:1"]), (1, ["user:1", "assistant:1"])] or sorted(
        (r.k, r.turns) for r in got if r.k == 1) == [(1, ["user:1", "assistant:0"]), (1, ["user:1", "assistant:1"])]
    whole = next(r for r in got if r.k is None)
    assert whole.turns == [f"assistant:{len(long)}", "user:1"] and whole.loss == [long]
    assert sorted((r.k, r.unknown) for r in got if r.k in (3, 4, 5)) == [(3, True), (4, True), (5, False)]


def test_mixing_with_equal_and_null_ids(spark):
    """A third of all rows with null ids, many of one size, and clashing columns: budgets are met to the word, also by the documents mixed."""
    rows = [(None, "a", "one two")] * 200 + [(7, "b", "x y z")] * 150 + [(i, "c" if i % 2 else None, "w " * (i % 9)) for i in range(250)]
    frame = spark.createDataFrame([(*r, 1, "s", 5) for r in rows], "doc_id long, source string, text string, __id int, __source string, row int")
    for got, size, taken, target in ((mixing.mix(frame), "size", "taken", "target"), (mixing.mixed_documents(frame), "mix_size", "mix_taken", "mix_target")):
        totals = {r.source: (r.t, r.target, r.most) for r in got.groupBy("source").agg(F.sum(taken).alias("t"), F.max(target).alias("target"), F.max(F.col(taken) - 3 * F.col(size)).alias("most")).collect()}
        assert len(totals) == 4 and all(t == round(want) and most <= 0 for t, want, most in totals.values())
    assert set(frame.columns) < set(mixing.mixed_documents(frame).columns)
