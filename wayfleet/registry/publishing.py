"""Queries over tables that are published as a whole: partitions switched together, versions audited before they are seen."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wayfleet.operators.latest import latest_per_key
from wayfleet.operators.quality import Checks
from wayfleet.operators.upsert import by_name, within_partitions
from wayfleet.registry.base import query, table
from wayfleet.schemas import record
from wayfleet.session import scratch
from wayfleet.sinks import audited, published

_MONTHS = ("order_year", "order_month")
_DATED = record(o_orderkey="bigint", o_custkey="bigint", o_totalprice="double", seen="bigint", order_year="string", order_month="string")


def _orders(spark, d, at, seen):
    """Orders as of a delivery, under the month of the date given."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), F.col("o_totalprice").cast("double"), F.lit(seen).cast("bigint").alias("seen"),
        F.date_format(at, "yyyy").alias("order_year"), F.date_format(at, "MM").alias("order_month"))


@query("atomic_publish", """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, strftime(o_orderdate, '%Y') AS order_year,
    strftime(o_orderdate, '%m') AS order_month FROM orders""")
def atomic_publish(spark, d):
    """Orders first under a wrong month, a second delivery that moves them, then a compaction: each order once, under its month."""
    out = published.Published(f"wayfleet_{uuid.uuid4().hex[:8]}", "orders", _DATED, _MONTHS, scratch(spark, "published"))
    date, wrong = F.col("o_orderdate"), F.add_months("o_orderdate", 5)
    third = F.col("o_orderkey") % 3 == 0
    published.publish(_orders(spark, d, F.when(third, wrong).otherwise(date), 1), out)
    fresh = _orders(spark, d, date, 2).filter(third)
    stored = published.read(spark, out)
    months = stored.join(fresh.select("o_orderkey"), "o_orderkey", "left_semi").select(*_MONTHS).unionByName(fresh.select(*_MONTHS)).distinct()
    merged = latest_per_key(by_name(within_partitions(stored, months, _MONTHS).select(*_DATED.names), fresh), ["o_orderkey"], ["seen"])
    published.publish(merged, out, months)
    published.compact(spark, out, F.col("order_year") >= "1995")
    return published.read(spark, out).select("o_orderkey", "o_totalprice", *_MONTHS)


@query("gated_publish", """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS verdict, CAST(NULL AS BIGINT) AS repeated_keys,
    CAST(NULL AS BIGINT) AS record_count FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 1, NULL, 'published', 0, count(*) FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 2, NULL, 'refused', count(CASE WHEN o_orderkey % 2 = 0 THEN 1 END), count(*) + count(CASE WHEN o_orderkey % 2 = 0 THEN 1 END) FROM orders
    UNION ALL SELECT 3, NULL, 'refused', 0, count(*) FROM orders""")
def gated_publish(spark, d):
    """Three versions: half of the orders, which passes; all of them with that half twice; all of them with a required column empty. Readers keep the first."""
    root = scratch(spark, "gated")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), F.col("o_totalprice").cast("double"))
    checks = Checks(required=("o_custkey", "o_totalprice", "o_absent"), ranges={"o_totalprice": (0, 1_000_000)}, unique="o_orderkey", nested=())
    good = Checks(required=("o_custkey", "o_totalprice"), ranges=checks.ranges, unique="o_orderkey", nested=())
    half = rows.filter("o_orderkey % 2 = 0")
    audited.publish_audited(half, root, good, ["o_orderkey"])
    audited.publish_audited(rows.unionByName(half), root, good, ["o_orderkey"])
    audited.publish_audited(rows.withColumn("o_custkey", F.lit(None).cast("bigint")).withColumn("o_totalprice", -F.col("o_totalprice")), root, checks, ["o_orderkey"])
    seen = audited.current(spark, root, rows.schema).select("o_orderkey", "o_totalprice", F.lit(None).cast("string").alias("verdict"),
                                                            F.lit(None).cast("bigint").alias("repeated_keys"), F.lit(None).cast("bigint").alias("record_count"))
    found = audited.verdicts(spark, root).select(
        F.col("version").cast("bigint").alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice"), "verdict", "repeated_keys", "record_count")
    return seen.unionByName(found)
