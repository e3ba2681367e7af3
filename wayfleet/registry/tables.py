"""The generic operators on the given tables, columns taking the vehicle roles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfleet.functions import alerts, insurance, ratios, status
from wayfleet.functions.clock import date_parts, event_time_or, on_day
from wayfleet.functions.parsing import LEGACY_NUMERIC, iso_date, iso_timestamp, numeric, weekday_timestamp
from wayfleet.functions.text import tidy, title_case
from wayfleet.operators import monthly, quality
from wayfleet.operators.flatten import flatten_all, snake_columns
from wayfleet.operators.latest import distinct_rows, duplicate_keys, latest_per_key
from wayfleet.operators.ranking import rank_all, rank_within, top_k, top_ranks
from wayfleet.operators.reconcile import reconcile
from wayfleet.operators.sections import custom_order, section, stack
from wayfleet.operators.summary import daily, distribution, pct_in_range, violation_rate, with_group_count, with_share
from wayfleet.operators.upsert import by_name, not_yet_stored, upsert_latest
from wayfleet.plans.silver import legacy_silver
from wayfleet.registry.base import query, rounded, table
from wayfleet.registry.fleet import LEGACY_FLAT, legacy_events
from wayfleet.registry.telemetry import settle
from wayfleet.session import scratch
from wayfleet.sinks.files import append

AS_OF = dt.date(1998, 9, 2)


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


# --- dedup, latest, upsert ------------------------------------------------------------

_DOUBLED = """twice AS (SELECT event_id, ts, user_id, value, 0 AS delivery FROM events
    UNION ALL SELECT event_id, ts, user_id, value, 1 AS delivery FROM events WHERE event_id % 3 <> 1
    UNION ALL SELECT event_id, ts, user_id, value, 1 AS delivery FROM events WHERE event_id % 3 = 0)"""


def _redelivered(spark: SparkSession, d: str) -> DataFrame:
    """All events, most of them delivered again, some of those twice over."""
    first = _events(spark, d).select("event_id", "ts", "user_id", "value", F.lit(0).alias("delivery"))
    again = first.withColumn("delivery", F.lit(1))
    return by_name(first, again.filter("event_id % 3 <> 1"), again.filter("event_id % 3 = 0"))


@query("dedup_events", f"""WITH {_DOUBLED} SELECT event_id, ts, user_id, value, delivery FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, delivery DESC) AS rn FROM twice) WHERE rn = 1""")
def dedup_events(spark, d):
    return latest_per_key(_redelivered(spark, d), ["event_id"], ["ts", "delivery"])


@query("distinct_rows", f"WITH {_DOUBLED} SELECT DISTINCT * FROM twice")
def distinct_event_rows(spark, d):
    return distinct_rows(_redelivered(spark, d))


@query("duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicates(spark, d):
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("latest_state", """SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY value DESC NULLS LAST, ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_state(spark, d):
    latest = latest_per_key(_events(spark, d), ["user_id"], ["value", "ts", "event_id"])
    return latest.select("event_id", "ts", "user_id", "event_type", "value")


@query("latest_order_per_customer", """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (SELECT *, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_order_per_customer(spark, d):
    latest = latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_totalprice", "o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


@query("daily_upsert", """SELECT event_id, user_id, value, y, m, d, CASE WHEN event_id % 2 = 0 THEN event_type END AS event_type
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, y, m, d ORDER BY value DESC, event_id DESC) AS rn FROM (
    SELECT *, strftime(ts, '%Y') AS y, strftime(ts, '%m') AS m, strftime(ts, '%d') AS d FROM events)) WHERE rn = 1""")
def daily_upsert(spark, d):
    """Odd events arrive as a batch lacking a column; even ones are already stored."""
    parts = date_parts(F.col("ts"), "event")
    rows = _events(spark, d).select(
        "event_id", "user_id", "value", "event_type",
        parts["event_year"].alias("y"), parts["event_month"].alias("m"), parts["event_day"].alias("d"),
    )
    stored, batch = rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1").drop("event_type")
    return upsert_latest(batch, stored, ["user_id", "y", "m", "d"], ["value", "event_id"])


@query("antijoin_new_keys", "SELECT event_id, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'")
def antijoin_new_keys(spark, d):
    rows = _events(spark, d).select("event_id", "user_id", "value", "ts")
    stored = rows.filter(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    return not_yet_stored(rows, by_name(stored, stored), ["event_id"]).drop("ts")


# --- monthly totals -------------------------------------------------------------------

_BY_SUPPLIER = """SELECT l_suppkey, strftime(l_shipdate, '%Y') AS event_year, strftime(l_shipdate, '%m') AS event_month,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_price,
    CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS total_quantity, count(*) AS lines
    FROM lineitem WHERE l_suppkey IS NOT NULL AND l_extendedprice >= 0 AND l_quantity >= 0 GROUP BY ALL"""


def _supplier_months(lines: DataFrame) -> DataFrame:
    """Totals per supplier and month; the month is spelled out once per group, not per row."""
    usable = monthly.usable(lines, ["l_suppkey", "l_shipdate"], ["l_extendedprice", "l_quantity"])
    rows = usable.select("l_suppkey", F.date_trunc("month", "l_shipdate").alias("month"),
                         F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
                         F.col("l_quantity").cast("decimal(18,2)").alias("quantity"))
    summed = monthly.totals(rows, ["l_suppkey", "month"],
                            {"total_price": "price", "total_quantity": "quantity", "lines": F.lit(1)})
    parts = date_parts(F.col("month"), "event")
    named = {n: parts[n] for n in ("event_year", "event_month")}
    return summed.withColumns(named).drop("month")


def _with_ratio(totals: DataFrame) -> DataFrame:
    price, quantity = F.col("total_price").cast("double"), F.col("total_quantity").cast("double")
    return totals.withColumns({
        "total_price": price,
        "total_quantity": quantity,
        "price_per_unit": ratios.km_per_litre(price, quantity),
    })


_RATIO_SQL = f"SELECT *, {rounded('total_price / nullif(total_quantity, 0)', 2)} AS price_per_unit FROM ({_BY_SUPPLIER})"


@query("monthly_efficiency", _RATIO_SQL)
def monthly_efficiency(spark, d):
    return _with_ratio(_supplier_months(table(spark, d, "lineitem")))


@query("incremental_merge", _RATIO_SQL)
def incremental_merge(spark, d):
    """Two halves aggregated apart, then merged: the one-pass totals."""
    lines = table(spark, d, "lineitem")
    late = F.col("l_orderkey") % 2 == 1
    halves = by_name(_supplier_months(lines.filter(late)), _supplier_months(lines.filter(~late)))
    merged = monthly.totals(halves, ["l_suppkey", "event_year", "event_month"],
                            {"total_price": "total_price", "total_quantity": "total_quantity", "lines": "lines"})
    return _with_ratio(merged)


# --- classification -------------------------------------------------------------------

@query("expiry_status", """SELECT o_orderkey,
    CASE WHEN u < a THEN 'VENCIDO' ELSE 'ATIVO' END AS two_way,
    CASE WHEN u < a THEN 'VENCIDO' WHEN u - a <= 90 THEN 'VENCENDO_EM_90_DIAS' ELSE 'ATIVO' END AS three_way
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS u, DATE '1998-09-02' AS a FROM orders)""")
def expiry_status(spark, d):
    until = F.when(F.col("o_orderkey") % 17 != 0, F.to_date("o_orderdate"))
    now = F.lit(AS_OF)
    return table(spark, d, "orders").select(
        "o_orderkey",
        insurance.two_way_status(until, now).alias("two_way"),
        insurance.three_way_status(until, now).alias("three_way"),
    )


@query("expiry_days", """SELECT o_orderkey, CAST(u - a AS INT) AS days_to_expiry,
    CASE WHEN u < a THEN CAST(a - u AS INT) END AS days_expired, CASE WHEN u < a THEN CAST(a - u AS INT) ELSE 0 END AS days_expired_or_zero
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS u, DATE '1998-09-02' AS a FROM orders)""")
def expiry_days(spark, d):
    until = F.when(F.col("o_orderkey") % 17 != 0, F.to_date("o_orderdate"))
    now = F.lit(AS_OF)
    return table(spark, d, "orders").select(
        "o_orderkey",
        insurance.days_left(until, now).alias("days_to_expiry"),
        insurance.overdue_days(until, now).alias("days_expired"),
        insurance.overdue_days(until, now, 0).alias("days_expired_or_zero"),
    )


@query("risk_category", """SELECT o_orderkey, CASE WHEN u < a THEN 'ALTO_RISCO' WHEN u - a <= 90 THEN 'MEDIO_RISCO' ELSE 'BAIXO_RISCO' END AS risk
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS u, DATE '1998-09-02' AS a FROM orders)""")
def risk_category(spark, d):
    standing = insurance.three_way_status(F.to_date("o_orderdate"), F.lit(AS_OF))
    return table(spark, d, "orders").select("o_orderkey", insurance.risk_category(standing).alias("risk"))


_SENSOR_RULES = (
    alerts.Rule("QUANTITY", "l_quantity", 48),
    alerts.Rule("DISCOUNT", "l_discount", 0.09),
    alerts.Rule("TAX", "l_tax", 0.07),
)


@query("alerts_single", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN l_quantity > 48 THEN 'QUANTITY' WHEN l_discount > 0.09e0 THEN 'DISCOUNT' ELSE 'TAX' END AS alert_type,
    CASE WHEN l_quantity > 48 THEN l_quantity WHEN l_discount > 0.09e0 THEN l_discount ELSE l_tax END AS alert_value
    FROM lineitem WHERE l_quantity > 48 OR l_discount > 0.09e0 OR l_tax > 0.07e0""")
def alerts_single(spark, d):
    found = alerts.one_alert_per_row(table(spark, d, "lineitem"), _SENSOR_RULES)
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "alert_type", "alert_value")


@query("alerts_multi", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'QUANTITY' AS alert_type, l_quantity AS alert_value FROM lineitem WHERE l_quantity > 48
    UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'DISCOUNT', l_discount FROM lineitem WHERE l_discount > 0.09e0
    UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'TAX', l_tax FROM lineitem WHERE l_tax > 0.07e0""")
def alerts_multi(spark, d):
    found = alerts.every_alert(table(spark, d, "lineitem"), _SENSOR_RULES)
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "alert_type", "alert_value")


_SPENT = "CASE WHEN l_orderkey % 13 = 0 THEN 0 ELSE l_quantity END"


@query("ratio_kpis", f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    {rounded(f'{_SPENT} / nullif(l_extendedprice, 0) * 100', 2)} AS per_100,
    {rounded('l_extendedprice / nullif((l_partkey % 60) / 60, 0)', 2)} AS speed,
    CASE WHEN {_SPENT} > 0 THEN {rounded(f'l_extendedprice / nullif({_SPENT}, 0)', 2)} ELSE 0e0 END AS per_unit,
    CASE WHEN {_SPENT} > 0 THEN {rounded(f'l_extendedprice / nullif({_SPENT}, 0)', 2)} END AS per_unit_or_null,
    {rounded('l_quantity / nullif(l_suppkey % 9, 0)', 4)} AS level_ratio,
    {rounded('l_quantity / nullif(l_suppkey % 9, 0) * 100', 1)} AS level_pct,
    {rounded('(l_quantity + l_discount + l_tax + l_linenumber) / 4', 1)} AS mean_of_four FROM lineitem""")
def ratio_kpis(spark, d):
    price, spent = F.col("l_extendedprice"), F.when(F.col("l_orderkey") % 13 == 0, 0).otherwise(F.col("l_quantity"))
    capacity = F.col("l_suppkey") % 9
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        ratios.litres_per_100km(spent, price).alias("per_100"),
        ratios.average_speed(price, F.col("l_partkey") % 60).alias("speed"),
        ratios.km_per_litre(price, spent, empty=0.0).alias("per_unit"),
        ratios.km_per_litre(price, spent).alias("per_unit_or_null"),
        ratios.fill_level(F.col("l_quantity"), capacity, scale=1, digits=4).alias("level_ratio"),
        ratios.fill_level(F.col("l_quantity"), capacity, digits=1).alias("level_pct"),
        ratios.mean_of([F.col(c) for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")]).alias("mean_of_four"),
    )


@query("threshold_status", """SELECT p_partkey,
    CASE WHEN p_size < 20 THEN 'CRITICAL' WHEN p_size < 50 THEN 'LOW' ELSE 'OK' END AS oil,
    CASE WHEN p_size < 20 THEN 'CRITICAL' WHEN p_size < 40 THEN 'LOW' ELSE 'OK' END AS battery,
    CASE WHEN p_size / 50e0 < 0.15e0 THEN 'CRITICAL' WHEN p_size / 50e0 < 0.30e0 THEN 'LOW' ELSE 'OK' END AS fuel,
    CASE WHEN p_size < 10 THEN 'CRÍTICO' WHEN p_size < 20 THEN 'BAIXO' ELSE 'OK' END AS fuel_label,
    CASE WHEN p_retailprice * 5 > 10000 THEN 'OVERDUE' WHEN p_retailprice * 5 > 8000 THEN 'DUE_SOON' ELSE 'OK' END AS service,
    CASE WHEN p_size * 3 > 100 THEN 'OVERHEATING' WHEN p_size * 3 > 95 THEN 'HIGH' ELSE 'NORMAL' END AS engine,
    CASE WHEN p_retailprice * 30 > 50000 THEN 'High' WHEN p_retailprice * 30 > 25000 THEN 'Medium' ELSE 'Low' END AS price,
    1998 - (1950 + p_size) AS age FROM part""")
def threshold_status(spark, d):
    size, price = F.col("p_size"), F.col("p_retailprice")
    return table(spark, d, "part").select(
        "p_partkey",
        status.below(size, status.OIL_BELOW).alias("oil"),
        status.below(size, status.BATTERY_BELOW).alias("battery"),
        status.below(ratios.fill_ratio(size, F.lit(50)), status.FUEL_RATIO_BELOW).alias("fuel"),
        status.below(size, status.FUEL_PERCENT_BELOW).alias("fuel_label"),
        status.above(price * 5, status.SERVICE_KM_ABOVE).alias("service"),
        status.above(size * 3, status.ENGINE_TEMP_ABOVE, "NORMAL").alias("engine"),
        status.price_category(price * 30).alias("price"),
        status.vehicle_age(1950 + size, AS_OF).alias("age"),
    )


@query("overall_status", """SELECT p_partkey, CASE WHEN p_type = 'PROMO' OR p_size / nullif(p_partkey % 4, 0) < 3 OR p_size < 5
    THEN 'ATTENTION_REQUIRED' ELSE 'OPERATIONAL' END AS overall FROM part""")
def overall_status(spark, d):
    size = F.col("p_size")
    ratio = ratios.fill_ratio(size, F.col("p_partkey") % 4)
    overall = status.attention(F.col("p_type") == "PROMO", ratio < 3, size < 5)
    return table(spark, d, "part").select("p_partkey", overall.alias("overall"))


# --- distributions, ranks, reports ----------------------------------------------------

@query("status_share", f"""SELECT o_orderstatus, n, {rounded('n * 1e2 / sum(n) OVER ()', 2)} AS percentage
    FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)""")
def status_share(spark, d):
    return with_share(distribution(table(spark, d, "orders"), ["o_orderstatus"]), "n")


_SUPPLIER_MEANS = """means AS (SELECT l_suppkey, count(*) AS lines,
    CAST(round(avg(l_quantity), 1) AS DOUBLE) AS mean_quantity FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 3)"""


def _supplier_means(spark: SparkSession, d: str) -> DataFrame:
    grouped = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("lines"), F.round(F.avg("l_quantity"), 1).alias("mean_quantity"))
    return grouped.filter("lines >= 3")


@query("rank_efficiency", f"""WITH {_SUPPLIER_MEANS} SELECT * FROM (
    SELECT *, CAST(rank() OVER (ORDER BY mean_quantity DESC NULLS LAST) AS INT) AS rank FROM means) WHERE rank <= 10""")
def rank_efficiency(spark, d):
    return top_ranks(_supplier_means(spark, d), "mean_quantity", 10)


@query("rank_all_rows", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rank() OVER (ORDER BY l_extendedprice DESC NULLS LAST) AS rank FROM lineitem")
def rank_all_rows(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rank_all(lines, "l_extendedprice").drop("l_extendedprice")


@query("rank_in_segment", """SELECT c_custkey, c_mktsegment, CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC NULLS LAST) AS INT) AS rank FROM customer""")
def rank_in_segment(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return rank_within(rows, ["c_mktsegment"], "c_acctbal").drop("c_acctbal")


@query("top_problem_keys", """SELECT user_id, count(*) AS errors, max(ts) AS last_error FROM events WHERE event_type = 'error'
    GROUP BY user_id HAVING count(*) >= 3 ORDER BY errors DESC, user_id LIMIT 20""")
def top_problem_keys(spark, d):
    per_user = (
        _events(spark, d).filter("event_type = 'error'").groupBy("user_id")
        .agg(F.count("*").alias("errors"), F.max("ts").alias("last_error")).filter("errors >= 3")
    )
    return top_k(per_user, [F.col("errors").desc(), F.col("user_id").asc()], 20)


@query("sectioned_report", """SELECT 'SUMMARY' AS report_section, o_orderstatus AS status, count(*) AS orders, NULL AS order_key, max(o_totalprice) AS price
    FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT * FROM (SELECT 'LARGEST', o_orderstatus, NULL, o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)""")
def sectioned_report(spark, d):
    orders = table(spark, d, "orders")
    layout = {"status": "string", "orders": "bigint", "order_key": "bigint", "price": "double"}
    summary = orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    largest = top_k(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)
    parts = [
        section(summary, "SUMMARY", layout,
                {"status": F.col("o_orderstatus"), "orders": F.col("n"), "price": F.col("top")}),
        section(largest, "LARGEST", layout,
                {"status": F.col("o_orderstatus"), "order_key": F.col("o_orderkey"), "price": F.col("o_totalprice")}),
    ]
    return stack(parts).orderBy(
        F.col("report_section").desc(), custom_order(F.col("status"), ["P", "O", "F"]), F.col("price").desc_nulls_last()
    )


@query("distribution_and_rate", f"""SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS total_rows,
    (SELECT count(CASE WHEN value > 100 THEN 1 END) FROM events) AS alert_rows,
    (SELECT {rounded('count(CASE WHEN value > 100 THEN 1 END) * 1e2 / count(*)', 2)} FROM events) AS violation_rate_pct
    FROM events GROUP BY event_type""")
def distribution_and_rate(spark, d):
    events = _events(spark, d)
    rate = violation_rate(events, F.col("value") > 100)
    counted = distribution(events, ["event_type"])
    return counted.withColumns({c: rate.select(c).scalar() for c in rate.columns})


@query("stamped_total", "SELECT s_suppkey, (SELECT count(*) FROM supplier) AS total FROM supplier")
def stamped_total(spark, d):
    return with_group_count(table(spark, d, "supplier").select("s_suppkey"), "total")


@query("daily_trend", f"""SELECT CAST(ts AS DATE) AS event_date, {rounded('avg(value)', 9)} AS mean_value,
    {rounded('stddev_samp(value)', 9)} AS deviation, min(value) AS lowest, max(value) AS highest, count(*) AS readings,
    count(DISTINCT user_id) AS users FROM events GROUP BY CAST(ts AS DATE)""")
def daily_trend(spark, d):
    return daily(_events(spark, d), "ts", {
        "mean_value": F.round(F.avg("value"), 9),
        "deviation": F.round(F.stddev_samp("value"), 9),
        "lowest": F.min("value"),
        "highest": F.max("value"),
        "readings": F.count("*"),
        "users": F.countDistinct("user_id"),
    })


@query("partition_prune", """SELECT event_id, strftime(ts, '%Y') AS event_year, strftime(ts, '%m') AS event_month, strftime(ts, '%d') AS event_day
    FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""")
def partition_prune(spark, d):
    """One day of a day-partitioned table: only that day's files are read."""
    path = f"{scratch(spark, 'days')}/events"
    parts = date_parts(F.col("ts"), "event")
    append(_events(spark, d).select("event_id", *(c.alias(n) for n, c in parts.items())), path, list(parts))
    return spark.read.parquet(path).filter(on_day("2024", "01", "15"))


# --- quality --------------------------------------------------------------------------

_GAPPY = """gappy AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 23 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders)"""


def _gappy(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").drop("o_orderdate")
    return orders.withColumns({
        "o_orderstatus": F.when(F.col("o_orderkey") % 19 != 0, F.col("o_orderstatus")),
        "o_totalprice": F.when(F.col("o_orderkey") % 23 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")),
    })


@query("quality_score", f"""WITH {_GAPPY} SELECT o_orderpriority, count(*) AS record_count,
    count(*) - count(DISTINCT o_custkey) AS duplicate_count, count(*) - count(o_orderstatus) AS null_o_orderstatus,
    count(CASE WHEN o_totalprice < 0 OR o_totalprice > 1000000 THEN 1 END) AS out_of_range_o_totalprice,
    1 AS error_count, 3 AS warning_count, 65 AS quality_score, 'o_missing' AS missing_columns, false AS is_valid
    FROM gappy GROUP BY o_orderpriority""")
def quality_score(spark, d):
    checks = quality.Checks(required=("o_orderstatus", "o_missing"), ranges={"o_totalprice": (0, 1_000_000)},
                            unique="o_custkey", nested=())
    return quality.quality_report(_gappy(spark, d), checks, by="o_orderpriority")


@query("quality_nested", """SELECT event_type, count(*) AS record_count, 0 AS duplicate_count, count(*) - count(user_id) AS null_user_id,
    count(CASE WHEN event_type <> 'view' AND event_id % 3 = 0 THEN 1 END) AS nested_rows_metrics, 0 AS error_count,
    CASE WHEN count(*) > count(user_id) THEN 1 ELSE 0 END + CASE WHEN count(CASE WHEN event_type <> 'view' AND event_id % 3 = 0 THEN 1 END) = 0 THEN 1 ELSE 0 END AS warning_count,
    100 - 5 * (CASE WHEN count(*) > count(user_id) THEN 1 ELSE 0 END + CASE WHEN count(CASE WHEN event_type <> 'view' AND event_id % 3 = 0 THEN 1 END) = 0 THEN 1 ELSE 0 END) AS quality_score,
    '' AS missing_columns, true AS is_valid FROM events GROUP BY event_type""")
def quality_nested(spark, d):
    """The rule on nested records: present in a third of the events of most kinds, in none of one kind."""
    rows = _events(spark, d).withColumn("metrics", F.when((F.col("event_type") != "view") & (F.col("event_id") % 3 == 0), F.struct("value")))
    return quality.quality_report(rows, quality.Checks(required=("user_id",), ranges={}, unique=None), by="event_type")


@query("event_time_fallback", """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS event_year, strftime(o_orderdate, '%m') AS event_month, '1998' AS late_year, '09' AS late_month FROM orders""")
def event_time_fallback(spark, d):
    """Date parts from a column that is there, and from one that is absent, where the fallback stands in."""
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    moment = F.lit("1998-09-02 06:00:00").cast("timestamp")
    here, gone = date_parts(event_time_or(rows, "at", moment), "event"), date_parts(event_time_or(rows, "no_such_column", moment), "late")
    return rows.withColumns({**here, **gone}).select("o_orderkey", "event_year", "event_month", "late_year", "late_month")


@query("quality_by_layer", f"""WITH {_GAPPY} SELECT 'ORDERS' AS layer, count(*) AS total_records, count(DISTINCT o_custkey) AS unique_keys,
    count(*) - count(o_orderstatus) AS missing, {rounded('avg(CASE WHEN o_totalprice BETWEEN 0 AND 250000 THEN 1e0 ELSE 0e0 END) * 100', 2)} AS valid_pct FROM gappy
    UNION ALL SELECT 'EVENTS', count(*), count(DISTINCT user_id), count(*) - count(props),
    {rounded('avg(CASE WHEN value BETWEEN 0 AND 50 THEN 1e0 ELSE 0e0 END) * 100', 2)} FROM events
    UNION ALL SELECT 'LINEITEM', count(*), count(DISTINCT l_suppkey), count(*) - count(l_shipdate),
    {rounded('avg(CASE WHEN l_quantity BETWEEN 5 AND 45 THEN 1e0 ELSE 0e0 END) * 100', 2)} FROM lineitem""")
def quality_by_layer(spark, d):
    def layer(name, df, key, needed, measure, low, high):
        figures = df.agg(
            F.count("*").alias("total_records"), F.countDistinct(key).alias("unique_keys"),
            F.count_if(F.col(needed).isNull()).alias("missing"),
            F.round(pct_in_range(measure, low, high), 2).alias("valid_pct"),
        )
        return figures.select(F.lit(name).alias("layer"), "*")

    return stack([
        layer("ORDERS", _gappy(spark, d), "o_custkey", "o_orderstatus", "o_totalprice", 0, 250000),
        layer("EVENTS", _events(spark, d), "user_id", "props", "value", 0, 50),
        layer("LINEITEM", table(spark, d, "lineitem"), "l_suppkey", "l_shipdate", "l_quantity", 5, 45),
    ])


@query("outliers", """SELECT event_id, value, value < lo - (hi - lo) * 1.5e0 OR value > hi + (hi - lo) * 1.5e0 AS is_outlier FROM events,
    (SELECT quantile_disc(value, 0.25) AS lo, quantile_disc(value, 0.75) AS hi FROM events)""")
def outliers(spark, d):
    return quality.unusual(_events(spark, d).select("event_id", "value"), "value")


@query("imputed_median", """SELECT event_id, user_id, coalesce(v, m) AS value FROM
    (SELECT event_id, user_id, CASE WHEN event_id % 11 <> 0 THEN value END AS v FROM events)
    LEFT JOIN (SELECT user_id, quantile_disc(value, 0.5) AS m FROM events WHERE event_id % 11 <> 0 GROUP BY user_id) USING (user_id)""")
def imputed_median(spark, d):
    gappy = _events(spark, d).select(
        "event_id", "user_id", F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value"))
    return quality.fill_with_median(gappy, "value", "user_id")


@query("reconcile_layers", """SELECT event_id, CAST(l AS BIGINT) AS left_copies, CAST(r AS BIGINT) AS right_copies,
    CASE WHEN r = 0 THEN 'missing_right' WHEN l = 0 THEN 'missing_left' WHEN event_id % 5 = 0 OR event_id % 11 = 0 THEN 'changed' ELSE 'matched' END AS verdict
    FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0 WHEN event_id % 11 = 0 THEN 3 WHEN event_id % 4 = 0 THEN 2 ELSE 1 END AS l,
        CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 11 = 0 THEN 3 ELSE 1 END AS r FROM events) WHERE l + r > 0""")
def reconcile_layers(spark, d):
    """Left lacks every 7th event and repeats every 4th; right lacks every 3rd and altered every 5th.

    Of every 11th event both sides hold three copies, of which one differs between the sides.
    """
    rows = _events(spark, d).select("event_id", "user_id", "value")
    thrice = rows.filter("event_id % 11 = 0")

    def copies(middle: int):
        return by_name(*(thrice.withColumn("value", F.col("value") + step) for step in (1000, middle)))

    left = by_name(rows, rows.filter("event_id % 4 = 0 AND event_id % 11 <> 0"), copies(300)).filter("event_id % 7 <> 0")
    right = by_name(rows.withColumn("value", F.when((F.col("event_id") % 5 == 0) & (F.col("event_id") % 11 != 0), F.col("value") + 1).otherwise(F.col("value"))),
                    copies(400)).filter("event_id % 3 <> 0")
    return reconcile(left, right, "event_id", ["user_id", "value"])


# --- text, types, structure -----------------------------------------------------------

@query("cleanse_text", """SELECT c_custkey,
    concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2))) AS nation,
    lower(c_mktsegment) AS segment, c_name AS name,
    CASE WHEN c_custkey % 2 = 0 THEN 'Mercedes-Benz' ELSE 'O''Brien Motors' END AS maker
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def cleanse_text(spark, d):
    customers = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = customers.select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower("n_name"), F.lit("\t")).alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.col("c_name"), F.lit(" \n")).alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("MERCEDES-BENZ")).otherwise(F.lit("o'brien motors")).alias("maker"),
    )
    tidied = tidy(raw, title=["nation"], lower=["segment"], trim=True)
    return tidied.withColumn("maker", title_case(F.col("maker"), every_break=True))


@query("typed_columns", """SELECT o_orderkey,
    CASE WHEN o_orderkey % 10 <> 3 THEN o_orderdate END AS iso_time,
    CASE WHEN o_orderkey % 10 <> 4 THEN o_orderdate END AS weekday_time,
    CASE WHEN o_orderkey % 10 <> 5 THEN CAST(o_orderdate AS DATE) END AS day,
    CASE WHEN o_orderkey % 10 <> 6 THEN o_totalprice END AS year FROM orders""")
def typed_columns(spark, d):
    key = F.col("o_orderkey") % 10
    text = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(key == 3, F.lit("2020-01-01T00:00:00.5Z"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso_time"),
        F.when(key == 4, F.lit("someday")).otherwise(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss")).alias("weekday_time"),
        F.when(key == 5, F.lit("1998-13-45")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(key == 6, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("year"),
    )
    typed = numeric(text, LEGACY_NUMERIC).withColumns({
        "iso_time": iso_timestamp(F.col("iso_time")),
        "weekday_time": weekday_timestamp(F.col("weekday_time")),
        "day": iso_date(F.col("day")),
    })
    return settle(typed)


@query("flatten_struct", """SELECT p_partkey AS part_key, p_name AS detail_part_name, p_brand AS detail_maker_brand_name,
    p_size AS detail_maker_size_mm, p_retailprice AS retail_price FROM part""")
def flatten_struct(spark, d):
    nested = table(spark, d, "part").select(
        F.col("p_partkey").alias("partKey"),
        F.struct(
            F.col("p_name").alias("partName"),
            F.struct(F.col("p_brand").alias("brandName"), F.col("p_size").alias("sizeMM")).alias("maker"),
        ).alias("detail"),
        F.col("p_retailprice").alias("retailPrice"),
    )
    return snake_columns(flatten_all(nested))


# --- first-generation records ---------------------------------------------------------

_LU = 'try_cast("carInsurance_validUntil" AS DATE)'
_LD = "DATE '1998-09-02'"

_LEGACY_SQL = f"""WITH {LEGACY_FLAT} SELECT "carChassis",
    CASE "Manufacturer" WHEN 'hyundai' THEN 'Hyundai' WHEN ' land ROVER' THEN 'Land Rover' ELSE 'Mercedes-benz' END AS "Manufacturer",
    trim(lower(color)) AS color, CASE WHEN "carInsurance_provider" = 'ALLIANZ' THEN 'Allianz' ELSE 'Porto Seguro' END AS "carInsurance_provider",
    CAST("currentMileage" AS DOUBLE) AS "currentMileage",
    CASE WHEN "metrics_metricTimestamp" <> 'late' THEN o_orderdate + to_seconds(o_orderkey % 86400) END AS "metrics_metricTimestamp",
    {_LU} AS "carInsurance_validUntil",
    {rounded('"metrics_fuelAvailableLiters" / nullif("fuelCapacityLiters", 0) * 100', 2)} AS metrics_fuel_level_percentage,
    CASE WHEN "metrics_trip_tripFuelLiters" > 0 THEN {rounded('"metrics_trip_tripMileage" / nullif("metrics_trip_tripFuelLiters", 0)', 2)} ELSE 0e0 END AS metrics_trip_km_per_liter,
    CAST({_LU} - {_LD} AS INT) AS insurance_days_to_expiry,
    CASE WHEN {_LU} < {_LD} THEN 'VENCIDO' WHEN {_LU} - {_LD} <= 90 THEN 'VENCENDO_EM_90_DIAS' ELSE 'ATIVO' END AS insurance_status,
    CASE WHEN {_LU} < {_LD} THEN CAST({_LD} - {_LU} AS INT) ELSE 0 END AS insurance_days_expired,
    CASE WHEN "metrics_metricTimestamp" <> 'late' THEN strftime(o_orderdate, '%Y') END AS event_year,
    CASE WHEN "metrics_metricTimestamp" <> 'late' THEN strftime(o_orderdate, '%m') END AS event_month,
    CASE WHEN "metrics_metricTimestamp" <> 'late' THEN strftime(o_orderdate, '%d') END AS event_day
    FROM flat"""

_LEGACY_COLUMNS = (
    "carChassis", "Manufacturer", "color", "carInsurance_provider", "currentMileage", "metrics_metricTimestamp",
    "carInsurance_validUntil", "metrics_fuel_level_percentage", "metrics_trip_km_per_liter", "insurance_days_to_expiry",
    "insurance_status", "insurance_days_expired", "event_year", "event_month", "event_day",
)


@query("legacy_flatten", f"WITH {LEGACY_FLAT} SELECT * EXCLUDE (o_orderkey, o_orderdate) FROM flat")
def legacy_flatten(spark, d):
    return flatten_all(legacy_events(spark, d))


@query("legacy_silver", _LEGACY_SQL)
def legacy_silver_rows(spark, d):
    return settle(legacy_silver(legacy_events(spark, d), AS_OF).select(*_LEGACY_COLUMNS))


@query("legacy_current_state", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "carChassis"
    ORDER BY "currentMileage" DESC NULLS LAST, "metrics_metricTimestamp" DESC NULLS LAST) AS rn FROM ({_LEGACY_SQL})) WHERE rn = 1""")
def legacy_current_state(spark, d):
    """First-generation upsert: the even half is stored, the odd half arrives."""
    rows = legacy_silver(legacy_events(spark, d), AS_OF).select(*_LEGACY_COLUMNS)
    even = F.pmod(F.xxhash64("currentMileage", "metrics_metricTimestamp"), F.lit(2)) == 0
    merged = upsert_latest(rows.filter(~even), rows.filter(even), ["carChassis"],
                           ["currentMileage", "metrics_metricTimestamp"])
    return settle(merged)


@query("legacy_alerts", f"""WITH {LEGACY_FLAT} SELECT "carChassis", "metrics_metricTimestamp",
    CASE WHEN "metrics_engineTempCelsius" > 100 THEN 'OVERHEAT_ENGINE' WHEN "metrics_oilTempCelsius" > 110 THEN 'OVERHEAT_OIL' ELSE 'SPEEDING_ALERT' END AS alert_type,
    CAST(CASE WHEN "metrics_engineTempCelsius" > 100 THEN "metrics_engineTempCelsius" WHEN "metrics_oilTempCelsius" > 110 THEN "metrics_oilTempCelsius"
        ELSE "metrics_trip_tripMaxSpeedKm" END AS DOUBLE) AS alert_value
    FROM flat WHERE "metrics_engineTempCelsius" > 100 OR "metrics_oilTempCelsius" > 110 OR "metrics_trip_tripMaxSpeedKm" > 120""")
def legacy_alerts(spark, d):
    found = alerts.one_alert_per_row(flatten_all(legacy_events(spark, d)), alerts.LEGACY_RULES)
    return found.select("carChassis", "metrics_metricTimestamp", "alert_type", "alert_value")
