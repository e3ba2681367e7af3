"""Queries over the ingest of landing folders with files of several formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfleet.registry.base import query, table
from wayfleet.schemas import record
from wayfleet.session import scratch
from wayfleet.sources.landing import bucket_of
from wayfleet.streaming import ingest

_ORDER = record(o_orderkey="bigint", o_custkey="bigint", o_totalprice="double", o_orderpriority="string")


def _landing(spark, d) -> str:
    """Orders as JSON lines, CSV under two headers, Parquet, and files of an extension nobody declared; some values and rows are broken."""
    root = scratch(spark, "formats")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderpriority")
    lot, broken = F.col("o_orderkey") % 5, F.col("o_orderkey") % 11 == 0
    rows.filter(lot == 0).select(F.when(broken, F.lit('{"o_orderkey": ')).otherwise(F.to_json(F.struct("*"))).alias("value")).write.text(f"{root}/a/lines")
    # The text writer's extension is .txt: the folder holds what no format claims.
    texts = rows.select("o_orderkey", "o_custkey", F.when(broken, "much").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"), F.concat(F.lit('a "'), "o_orderpriority", F.lit('", b')).alias("o_orderpriority"))
    rows.filter(lot == 1).write.json(f"{root}/b/json")
    texts.filter(lot == 2).write.option("header", True).option("escape", '"').csv(f"{root}/c/first")
    texts.filter(lot == 3).select("o_totalprice", F.lit("x").alias("extra"), F.col("o_orderpriority").alias("O_OrderPriority"), "o_custkey", "o_orderkey").write.option(
        "header", True).option("escape", '"').csv(f"{root}/c/second")
    texts.filter(lot == 3).filter("o_orderkey % 7 = 0").select("o_custkey", F.lit("y").alias("unrelated")).write.option("header", True).csv(f"{root}/c/third")
    rows.filter(lot == 4).withColumn("o_orderkey", F.when(~broken, F.col("o_orderkey"))).write.parquet(f"{root}/d")
    return root


def ingested(spark, d) -> ingest.Paths:
    out = scratch(spark, "ingested")
    paths = ingest.Paths(_landing(spark, d), *(f"{out}/{n}" for n in ("table", "quarantine", "audit", "summary", "checkpoints")))
    for _ in range(2):  # the second call finds nothing new
        ingest.ingest(spark, paths, _ORDER, ["o_orderkey"])
    return paths


_GOOD = "o_orderkey % 11 <> 0"


@query("ingest_formats", f"""SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
    CASE WHEN o_orderkey % 5 IN (2, 3) THEN concat('a "', o_orderpriority, '", b') ELSE o_orderpriority END AS o_orderpriority, CAST(NULL AS VARCHAR) AS reason, CAST(1 AS BIGINT) AS n
    FROM orders WHERE o_orderkey % 5 = 1 OR (o_orderkey % 5 IN (2, 3, 4) AND {_GOOD})
    UNION ALL SELECT NULL, NULL, NULL, 'bad_value', count(*) FROM orders WHERE o_orderkey % 5 IN (2, 3) AND NOT ({_GOOD})
    UNION ALL SELECT NULL, NULL, NULL, 'missing_o_orderkey', count(*) FROM orders WHERE o_orderkey % 5 = 4 AND NOT ({_GOOD})
    UNION ALL SELECT NULL, NULL, NULL, 'foreign_layout', count(*) FROM orders WHERE o_orderkey % 5 = 3 AND o_orderkey % 7 = 0""")
def ingest_formats(spark, d):
    """Accepted rows of all formats, and how many were refused for what; files of an undeclared extension are counted by ``ingest_audit``."""
    paths = ingested(spark, d)
    good = spark.read.parquet(paths.table).select("o_orderkey", "o_totalprice", "o_orderpriority", F.lit(None).cast("string").alias("reason"), F.lit(1).cast("bigint").alias("n"))
    bad = spark.read.parquet(paths.quarantine).filter("reject_reason <> 'unknown_extension'").groupBy(F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))
    return good.unionByName(bad, allowMissingColumns=True)


@query("ingest_audit", f"""WITH lots AS (SELECT CASE o_orderkey % 5 WHEN 1 THEN 'json' WHEN 4 THEN 'parquet' ELSE 'csv' END AS format,
      o_orderkey % 5 = 1 OR {_GOOD} AS good FROM orders WHERE o_orderkey % 5 <> 0
      UNION ALL SELECT 'csv', false FROM orders WHERE o_orderkey % 5 = 3 AND o_orderkey % 7 = 0)
    SELECT format, count(CASE WHEN good THEN 1 END) AS rows_loaded, count(CASE WHEN NOT good THEN 1 END) AS rows_rejected,
      count(CASE WHEN good THEN 1 END) AS observed_loaded, count(CASE WHEN NOT good THEN 1 END) AS observed_rejected, true AS every_file_named, CAST(NULL AS VARCHAR) AS bucket FROM lots GROUP BY format
    UNION ALL SELECT 'other', 0, 1, NULL, NULL, true, NULL""")
def ingest_audit(spark, d):
    """Per-file audits summed by format, beside what was observed while the rows were written; the undeclared files are one folder's."""
    paths = ingested(spark, d)
    audit, loaded = spark.read.parquet(paths.audit), spark.read.parquet(paths.table)
    kind = F.substring_index("load_id", "-", 1)
    files = loaded.groupBy("source_file").agg(F.count("*").alias("stored"))
    named = audit.join(files, "source_file", "left").withColumn("same", F.coalesce("stored", F.lit(0)) == F.col("rows_loaded"))
    sums = named.groupBy(kind.alias("format")).agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"), F.min("same").alias("every_file_named"), F.max(bucket_of(F.col("source_file"))).alias("bucket"))
    # How many files the undeclared rows came in is the writer's affair: one line says that there were some.
    sums = sums.withColumn("rows_rejected", F.when(F.col("format") == "other", F.least("rows_rejected", F.lit(1))).otherwise(F.col("rows_rejected")))
    seen = spark.read.parquet(paths.summary).groupBy("format").agg(F.sum("rows_loaded").alias("observed_loaded"), F.sum("rows_rejected").alias("observed_rejected"))
    return sums.join(seen, "format", "left").select("format", "rows_loaded", "rows_rejected", "observed_loaded", "observed_rejected", "every_file_named", "bucket")
