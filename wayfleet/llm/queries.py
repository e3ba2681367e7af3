"""The thin queries over whole tables, one per operator, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm import (
    chat, language, lengths, licenses, mixing, negatives, outliers, packing, resampling, simhash, toxicity, warc, winnowing)
from wayfleet.llm.common import settle, table
from wayfleet.session import pin, scratch

Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        RUNS[name] = lambda spark, sf_dir: run(pin(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op2_warc_archive", sql="""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, encode(coalesce(html, '')) AS bytes FROM pages
), d AS (
  SELECT page_id, payload, octet_length(bytes) AS payload_bytes, upper(sha1(payload)) AS hex,
         max(page_id) OVER (PARTITION BY payload) AS response_id FROM p
), g AS (
  SELECT *, [('0x' || substr(hex, s, 10))::BIGINT FOR s IN [1, 11, 21, 31]] AS groups FROM d
)
SELECT page_id, payload_bytes,
       array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> b) & 31)::INT + 1, 1)
         FOR b IN [35, 30, 25, 20, 15, 10, 5, 0]], '') FOR v IN groups], '') AS payload_digest,
       CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < response_id THEN response_id END AS refers_to
FROM g""")
def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archive back, and report each record with its payload's length and digest."""
    archive = scratch(spark, "warc")
    warc.store(table(spark, sf_dir, "pages"), archive)
    return warc.records(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_mixing", sql=r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::BIGINT AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place FROM s
), v AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shares
  FROM l
), f AS (
  SELECT min_by(remaining, place) AS remaining, min_by(shares, place) AS shares FROM v WHERE weight * remaining <= cap * shares
), t AS (
  SELECT v.source, v.source_size,
         CASE WHEN v.weight * v.remaining > v.cap * v.shares THEN v.cap::DOUBLE
              ELSE (v.weight * f.remaining)::DOUBLE / f.shares::DOUBLE END AS target, v.cap
  FROM v CROSS JOIN f
), b AS (
  SELECT *, least(round(target)::BIGINT, cap) AS budget FROM t
), k AS (
  SELECT d.doc_id, d.size, b.source_size::BIGINT AS source_size, b.target,
         CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS whole, b.budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, budget - whole * source_size - before)))::BIGINT AS taken
FROM k""")
def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _records(rows: DataFrame) -> DataFrame:
    """Conversations as typed records, in the layout that fits their turns: a single exchange, one with a system text, or a list."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))))
    listed = rows.groupBy("conv_id").agg(turns.alias("rows"))
    roles, text = F.col("rows.role"), lambda i: F.get(F.col("rows"), F.lit(i))["text"]
    single = roles == F.array(F.lit("user"), F.lit("assistant"))
    instructed = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    messages = F.transform("rows", lambda t: F.struct(t["text"].alias("content"), t["role"].alias("role")))
    return listed.select(
        "conv_id", F.when(single, F.struct(text(0).alias("prompt"), text(1).alias("completion"))).alias("exchange"),
        F.when(instructed, F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))).alias("instructed"),
        F.when(~F.coalesce(single | instructed, F.lit(False)), F.struct(messages.alias("messages"))).alias("listed"))


_ESCAPED = "replace(t, '␛', '␛0')"
for _i, _control in enumerate(chat.CONTROLS, 1):
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '␛{_i}')"


@query("op6_chat_format", sql=f"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (SELECT *, {_ESCAPED} AS body FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(body) + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 7
                          ELSE 20 + length(coalesce(role, '␛9')) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one made of control strings; everything returned is read from the written output."""
    hostile = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hostile).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    turned = chat.typed_turns(_records(rows), ["exchange", "instructed", "listed"])
    out = settle(chat.format_turns(turned, "conv_id"), "chat")
    back = out.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss_mask")), ""))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op9_decontaminate", sql=r"""
WITH w AS (
  SELECT doc_id, rid, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM (SELECT *, row_number() OVER () AS rid FROM documents)
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, size, array_to_string(words[p:p + size - 1], ' ') AS win
  FROM (SELECT item_id, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p
        FROM i WHERE len(words) > 0)
), dw AS (
  SELECT rid, s.size, p, array_to_string(words[p:p + s.size - 1], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) + 1)) AS p FROM w) JOIN (SELECT DISTINCT size FROM iw) s ON p + s.size - 1 <= len(words)
), h AS (
  SELECT rid, dw.p, dw.size, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size
), c AS (
  SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS q FROM h) GROUP BY rid
), n AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM h) GROUP BY rid
)
SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (rid) LEFT JOIN n USING (rid)""")
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op5_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact histogram of token lengths over all documents with its sums."""
    return lengths.length_histogram(lengths.token_lengths(table(spark, sf_dir, "documents")))


@query("op7_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query("op8_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexed(F.col("print")).alias("fingerprint"), "component_id")


@query("op10_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return outliers.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def _remainder(parts: int):
    """The fold of a document: crc32 of its id as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts, F.lit(0))


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from two folds of three."""
    documents = table(spark, sf_dir, "documents")
    held_out = _remainder(3) == 1
    found = language.identify(documents, language.train(documents, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op1_toxicity")
def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of one fold of five are never read."""
    held_out = _remainder(5) == 0
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "posterior")


@query("op11_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens; only the digest of a piece's ids is kept."""
    packed = packing.pack(table(spark, sf_dir, "documents"), content=F.crc32)
    return packed.select("doc_id", "piece", "start", "length", F.col("ids").alias("ids_crc32"), "sequence_id", "offset")


# CRC-32 of a text's bytes in SQL, by the table of single bytes of the reflected polynomial of ISO 3309.
_CRC_TABLE = "SELECT list(list_reduce([b] || range(1, 9), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(256) r(b)"


@query("op12_resampling", sql=rf"""
WITH crc AS MATERIALIZED ({_CRC_TABLE}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents
), i AS (
  SELECT coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM benchmark
), f AS MATERIALIZED (
  SELECT rid, array_to_string(words[p:p + k - 1], ' ') AS run, count(*) AS n
  FROM (SELECT rid, words, k, unnest(range(1, len(words) - k + 2)) AS p FROM d, (VALUES (1), (2), (3)) v(k)) GROUP BY ALL
), g AS MATERIALIZED (
  SELECT array_to_string(words[p:p + k - 1], ' ') AS run, count(*) AS n
  FROM (SELECT words, k, unnest(range(1, len(words) - k + 2)) AS p FROM i, (VALUES (1), (2), (3)) v(k)) GROUP BY ALL
), h AS MATERIALIZED (
  SELECT run, xor(list_reduce([4294967295] || list_transform(range(0, octet_length(encode(run))), lambda j: ('0x' || substr(x, 2 * j + 1, 2))::BIGINT),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT run, hex(encode(run)) AS x FROM (SELECT DISTINCT run FROM f UNION SELECT DISTINCT run FROM g)), crc
), s AS (SELECT bucket, sum(n) AS s FROM f JOIN h USING (run) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM g JOIN h USING (run) GROUP BY bucket),
a AS (
  SELECT b AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t, coalesce((SELECT sum(n) FROM f), 0) AS big_s, coalesce((SELECT sum(n) FROM g), 0) AS big_t
  FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (big_s + 10000))::DOUBLE / ((s + 1) * (big_t + 10000))::DOUBLE))::BIGINT AS gain FROM a
), w AS (
  SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM f JOIN h USING (run) JOIN gains USING (bucket) GROUP BY rid
), z AS (
  SELECT rid, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (rid)
), r AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM z WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= floor(5 * n / 100) THEN place END AS rank FROM z LEFT JOIN r USING (rid)""")
def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark's words."""
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_hard_negatives", sql="""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS no, vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.no AS anchor_no, a.vec_id AS anchor_id, c.no AS no, c.vec_id AS id, a.label = c.label AS same,
         list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.no <> c.no WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_no ORDER BY score DESC, id, no) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_no, p.no ORDER BY n.score DESC, n.id, n.no)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_no = p.anchor_no AND NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY rank <= 3""")
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, one vector of seven under its neighbour's label."""
    vec_id = F.col("vec_id")
    mixed_up = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", mixed_up), vec_id % 50 == 0)
