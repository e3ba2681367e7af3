"""Content-addressed web archive: payload bytes stored once, exact record headers apart, records by join.

``store`` writes two Parquet tables.  ``payloads`` has every distinct payload once, under its
SHA-256; ``headers`` has one row per record with the exact bytes that stand before the
payload.  ``records`` joins the two back into whole records and checks every payload against the
digest it is stored under.  ``export`` writes the records as plain archive files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm.common import settle

# Fixed values of the archive format.
CRLF = "\r\n"
BETWEEN_RECORDS = CRLF + CRLF
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX_32, RFC_4648 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

LEAST_BYTES = 0


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are four groups of 40, eight digits each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), HEX_32, RFC_4648)


def _record_id(page_id: Column, url: Column) -> Column:
    """A name-based UUID, so that a rerun writes the same archive."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), F.coalesce(url, F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out.  Line ends in values would start a new field and become blanks."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]", " "), F.lit(CRLF)), F.lit("")) for name, value in fields])


def store(pages: DataFrame, archive: str, least_bytes: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as an archive below ``archive``.

    The payload is the html in UTF-8; null is an empty payload.  Of records with equal payloads of
    ``least_bytes`` or more the one with the largest page_id is the response and the others
    revisit it (of rows with that same id each is a response); smaller payloads, and groups without any page_id, are
    responses throughout.  No page gives an archive without records.  Extra columns are ignored.

    Only digests meet in the grouping that picks the response, so a payload that a third of
    the pages share costs one row per task; payload bytes are shuffled once, to be stored once.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select(
        "page_id", "url", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha2("payload", 256).alias("address"),
        base32_sha1(F.col("payload")).alias("digest"), "payload",
    )
    # Bytes under the same address from many pages: each task sends one copy on.  The two digests and the length together verify the address.
    kept = rows.groupBy("address", "n_bytes", "digest").agg(F.first("payload").alias("payload"))
    kept.write.mode("overwrite").option("compression", "zstd").parquet(f"{archive}/payloads")

    narrow = settle(rows.drop("payload"), "warc-rows")
    response = narrow.where(F.col("n_bytes") >= least_bytes).groupBy("address").agg(
        F.max("page_id").alias("response_id"), F.max_by("url", F.struct("page_id", "url")).alias("response_url"))
    known = narrow.join(response, "address", "left")
    revisit = F.coalesce(F.col("page_id") < F.col("response_id"), F.col("response_id").isNotNull())
    revisit = revisit & ~F.coalesce(F.col("page_id") == F.col("response_id"), F.lit(False))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF)
    )
    head = F.concat(
        F.lit(VERSION + CRLF),
        _lines(
            ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
            ("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Profile", F.when(F.col("revisit"), IDENTICAL)),
            ("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("response_id"), F.col("response_url")))),
            ("X-Page-ID", F.col("page_id")),
            ("X-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("response_id"))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("n_bytes"))),
        ),
        F.lit(CRLF), F.col("http"),
    )
    known.withColumn("revisit", revisit).withColumn("http", http).select(F.encode(head, "UTF-8").alias("head"), "address").write.mode(
        "overwrite").option("compression", "zstd").parquet(f"{archive}/headers")


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def records(spark: SparkSession, archive: str) -> DataFrame:
    """Every record of the archive with its fields read from its header, its whole payload, and ``intact``.

    ``intact``: the stored bytes still have the SHA-256 they are addressed by and the SHA-1 the header
    states.  A record whose payload is missing has a null payload and is not intact.  The checks
    are made where a payload is stored, before the join, so a reader who wants digests and lengths only moves no payload.
    """
    stored = spark.read.parquet(f"{archive}/payloads").select(
        "address", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        (F.sha2("payload", 256) == F.col("address")).alias("addressed"),
    )
    text = F.decode("head", "UTF-8")
    heads = spark.read.parquet(f"{archive}/headers").select(
        "address", "head", _field(text, "WARC-Type").alias("record_type"), _field(text, "WARC-Record-ID").alias("record_id"),
        _field(text, "WARC-Target-URI").alias("url"), _field(text, "X-Page-ID").cast("long").alias("page_id"),
        _field(text, "X-Refers-To-Page-ID").cast("long").alias("refers_to"), _field(text, "WARC-Payload-Digest").alias("stated_digest"),
    )
    intact = F.coalesce(F.col("addressed") & (F.col("stated_digest") == F.concat(F.lit("sha1:"), "payload_digest")), F.lit(False))
    return heads.join(stored, "address", "left").withColumn("intact", intact).drop("addressed")


def record_bytes(found: DataFrame) -> DataFrame:
    """``record``: the exact bytes of each record, header, block and closing line ends; a revisit has no payload of its own."""
    block = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return found.withColumn("record", F.concat("head", block, F.lit(BETWEEN_RECORDS).cast("binary")))


def export(found: DataFrame, path: str, records_per_file: int = 100_000) -> None:
    """Write records as archive files; the text writer's line separator is what closes a record."""
    whole = record_bytes(found.where("intact")).select(F.concat("head", F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))).cast("string").alias("value"))
    whole.write.mode("overwrite").option("lineSep", BETWEEN_RECORDS).option("maxRecordsPerFile", records_per_file).text(path)
