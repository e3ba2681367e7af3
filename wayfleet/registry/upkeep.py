"""Queries over rules, sketches, the catalog and checks of what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wayfleet.operators import rules, sketches
from wayfleet.registry.base import query, table
from wayfleet.session import scratch
from wayfleet.sinks import batches, files
from wayfleet.sources import tables

RULES = (
    rules.Rule("whole_discount", "l_discount BETWEEN 0 AND 0.08"),
    rules.Rule("shipped_after_order", "CAST(l_shipdate AS DATE) >= CAST(ordered.o_orderdate AS DATE)", applies="ordered.found"),
    rules.Rule("known_order", "ordered.found"),
    rules.Rule("known_supplier", "supplier.found AND supplier.s_acctbal >= 0", nulls_break=True),
    rules.Rule("returned_is_old", "CAST(l_shipdate AS DATE) < DATE '1995-06-18'", applies="l_returnflag = 'R'", severity=rules.WARNING),
)
_BROKEN = """lines AS (SELECT l_orderkey, l_linenumber, l_discount NOT BETWEEN 0 AND 0.08 AS b0, o_orderkey IS NOT NULL AND CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) AS b1,
      o_orderkey IS NULL AS b2, s_suppkey IS NULL OR s_acctbal < 0 AS b3, l_returnflag = 'R' AND CAST(l_shipdate AS DATE) >= DATE '1995-06-18' AS b4
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 13 <> 0) ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 9 <> 0) ON l_suppkey = s_suppkey)"""


def _ruled(spark, d):
    orders = table(spark, d, "orders").filter("o_orderkey % 13 <> 0")
    suppliers = table(spark, d, "supplier").filter("s_suppkey % 9 <> 0")
    references = [rules.Reference("ordered", orders, {"o_orderkey": "l_orderkey"}, ["o_orderdate"]), rules.Reference("supplier", suppliers, {"s_suppkey": "l_suppkey"}, ["s_acctbal"])]
    return rules.checked(table(spark, d, "lineitem"), RULES, references)


@query("business_rules", f"""WITH {_BROKEN} SELECT rule, severity, broken, (SELECT count(*) FROM lineitem) AS rows FROM (
      SELECT 'whole_discount' AS rule, 'error' AS severity, count(CASE WHEN b0 THEN 1 END) AS broken FROM lines
      UNION ALL SELECT 'shipped_after_order', 'error', count(CASE WHEN b1 THEN 1 END) FROM lines UNION ALL SELECT 'known_order', 'error', count(CASE WHEN b2 THEN 1 END) FROM lines
      UNION ALL SELECT 'known_supplier', 'error', count(CASE WHEN b3 THEN 1 END) FROM lines UNION ALL SELECT 'returned_is_old', 'warning', count(CASE WHEN b4 THEN 1 END) FROM lines)""")
def business_rules(spark, d):
    """How many lines break each rule over their own columns, their order and their supplier."""
    return rules.report(_ruled(spark, d), RULES).drop("broken_pct")


@query("rule_rejects", f"""WITH {_BROKEN} SELECT l_orderkey, l_linenumber,
      concat_ws(',', CASE WHEN b0 THEN 'whole_discount' END, CASE WHEN b1 THEN 'shipped_after_order' END, CASE WHEN b2 THEN 'known_order' END, CASE WHEN b3 THEN 'known_supplier' END,
        CASE WHEN b4 THEN 'returned_is_old' END) AS broken FROM lines WHERE b0 OR b1 OR b2 OR b3""")
def rule_rejects(spark, d):
    """The keys of all rejected lines with what they break."""
    return _ruled(spark, d).filter("rejected").select("l_orderkey", "l_linenumber", F.array_join("broken_rules", ",").alias("broken"))


@query("distinct_by_month", """SELECT strftime(ts, '%Y-%m') AS month, event_type, count(DISTINCT user_id) AS exact, true AS within_bound, count(*) AS n_rows FROM events GROUP BY ALL""")
def distinct_by_month(spark, d):
    """Users per month and kind from daily sketches stored in three batches, one of them twice; each estimate is held against the exact count, at four standard errors."""
    root, keys = scratch(spark, "sketches"), ["day", "event_type"]
    events = table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    lot = F.pmod(F.xxhash64("event_id"), F.lit(3))
    daily = [sketches.sketches(events.filter(lot == i), keys, "user_id") for i in range(3)]
    for i in (0, 1, 2, 1):
        batches.apply_batch(daily[i], root, str(i))
    merged = batches.merged(spark, root, daily[0].schema, lambda *frames: sketches.merge(*frames, keys=keys))
    found = sketches.estimates(merged.withColumn("month", F.substring("day", 1, 7)), ["month", "event_type"])
    exact = events.groupBy(F.substring("day", 1, 7).alias("month"), "event_type").agg(F.countDistinct("user_id").alias("exact"))
    off = F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * sketches.error_of() * F.col("exact"))
    return found.join(exact, ["month", "event_type"]).select("month", "event_type", "exact", off.alias("within_bound"), "n_rows")


@query("catalog_evolution", """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CASE WHEN o_orderdate >= DATE '1996-01-01' THEN o_orderpriority END AS o_orderpriority,
    strftime(o_orderdate, '%Y') AS order_year FROM orders""")
def catalog_evolution(spark, d):
    """Older files without a column that newer ones have, read through one catalog table: the column is added, and only the partitions a load wrote are registered."""
    path, database = scratch(spark, "evolved"), f"wayfleet_{uuid.uuid4().hex[:8]}"
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"), F.date_format("o_orderdate", "yyyy").alias("order_year"), "o_orderpriority")
    old, new = rows.filter("order_year < '1996'").drop("o_orderpriority"), rows.filter("order_year >= '1996'").select("o_orderkey", "o_totalprice", "o_orderpriority", "order_year")
    for load in (old, new):
        files.append(load, path, ["order_year"])
        tables.create_external(spark, database, "orders", load.schema, path, ["order_year"])
        tables.evolve(spark, database, "orders", load.schema, ["order_year"])
        tables.add_partitions(spark, database, "orders", load, ["order_year"])
    return tables.table(spark, database, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "order_year")


@query("footer_counts", """SELECT strftime(o_orderdate, '%Y') AS order_year, count(*) AS n_rows FROM orders GROUP BY ALL""")
def footer_counts(spark, d):
    """Rows of every partition of a written table, told by its files' footers."""
    path = scratch(spark, "footers")
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("order_year"))
    files.append(rows, path, ["order_year"])
    return files.footer_counts(spark, path, rows.schema, ["order_year"])
