"""Sources, sinks and streams: data is written to the shared scratch folder in the
form under test and read back through the package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfleet import schemas
from wayfleet.functions.clock import date_parts
from wayfleet.functions.parsing import iso_timestamp
from wayfleet.operators import monthly
from wayfleet.operators.flatten import EVENT_PATHS, pick
from wayfleet.operators.latest import may_be_latest
from wayfleet.plans import medallion
from wayfleet.plans.bronze import load_audit, require, to_bronze
from wayfleet.plans.gold import alert_log
from wayfleet.plans.silver import EVENT_RECENCY, STATE_RECENCY, dated, flatten_events, one_row_per_event, silver
from wayfleet.registry.base import query, rounded, settled, table
from wayfleet.registry.fleet import ALERTS, FLAT, FUEL, LOT, SILVER, STATE, event_parts, events, folded_sql, state_sql
from wayfleet.registry.telemetry import AS_OF, settle
from wayfleet.session import scratch
from wayfleet.sinks import batches, files, snapshots
from wayfleet.sources import landing, tables
from wayfleet.streaming import changes, jobs
from wayfleet.streaming.sources import drain, parquet_stream

# --- JSON, CSV, Parquet ---------------------------------------------------------------

_SAMPLE = "event_id, car_chassis, event_timestamp, current_mileage_km, trip_distance_km, tire_pressure_rear_right_psi"
_SAMPLE_COLUMNS = [c.strip() for c in _SAMPLE.split(",")]


# Landing text is kept packed: as plain text the nested records take a hundred times the room of the table they come from.
_TEXTS = "*.txt.gz"


def _write_text(lines: DataFrame, path: str, per_file: int | None = None) -> str:
    writer = lines.write.option("maxRecordsPerFile", per_file) if per_file else lines.write
    writer.option("compression", "gzip").text(path)
    return path


def _as_json(spark: SparkSession, d: str, path: str, per_file: int | None = None, folded: bool = False) -> str:
    return _write_text(events(spark, d, folded, in_order=True).select(F.to_json(F.struct("*")).alias("value")), path, per_file)


@query("json_lines_scan", f"WITH {FLAT} SELECT {_SAMPLE} FROM flat")
def json_lines_scan(spark, d):
    path = _as_json(spark, d, scratch(spark, "lines"))
    records = landing.json_lines(spark, path, schemas.EVENT, glob=_TEXTS)
    return settle(flatten_events(records).select(*_SAMPLE_COLUMNS))


@query("json_array_scan", f"WITH {FLAT} SELECT {_SAMPLE} FROM flat")
def json_array_scan(spark, d):
    """Files holding one array of at most 5000 objects, read by the multi-line reader."""
    path = scratch(spark, "arrays")
    made = events(spark, d, lots_of=5000)
    records = F.struct(*(c for c in made.columns if c != LOT))
    # The rows of a lot are in one task already. A task's memory holds its lots as text.
    grouped = made.groupBy(LOT).agg(F.collect_list(F.to_json(records)).alias("_texts"))
    _write_text(grouped.select(F.concat(F.lit("["), F.array_join("_texts", ","), F.lit("]")).alias("value")), path, 1)
    records = landing.json_documents(spark, path, schemas.EVENT, glob=_TEXTS)
    return settle(flatten_events(records).select(*_SAMPLE_COLUMNS))


@query("csv_scan", f"WITH {SILVER} SELECT event_id, car_chassis, current_mileage_km, oil_status, trip_distance_km FROM silver")
def csv_scan(spark, d):
    path = scratch(spark, "csv")
    flat = silver(events(spark, d), AS_OF).select(
        "event_id", "car_chassis", "current_mileage_km", "oil_status", "trip_distance_km")
    # Written in another order than it is asked for.
    flat.select(*reversed(flat.columns)).write.option("header", True).csv(path)
    return landing.csv_rows(spark, path, flat.schema)


@query("ingest_roundtrip", f"""WITH {FLAT} SELECT {_SAMPLE},
    '1998' AS ingest_year, '09' AS ingest_month, '02' AS ingest_day, '1998-09-02T06:00:00' AS ingestion_timestamp FROM flat""")
def ingest_roundtrip(spark, d):
    """Landing lines -> parsed records -> partitioned Bronze -> flat rows."""
    source = _as_json(spark, d, scratch(spark, "landing"))
    parsed = landing.parse_landing(landing.landing_text(spark, source, glob=_TEXTS, shape=landing.LINES), schemas.EVENT)
    at = F.lit("1998-09-02 06:00:00").cast("timestamp")
    bronze = scratch(spark, "bronze")
    # One day, and a file for each landing file: nothing to gather.
    files.append_load(to_bronze(landing.accepted(parsed), at), bronze, schemas.INGEST_PARTITIONS, 0, as_read=True, codec=files.PACKED)
    stored = spark.read.schema(schemas.BRONZE).parquet(bronze).filter("ingest_year = '1998' AND ingest_month = '09'")
    wanted = {c: EVENT_PATHS[c] for c in _SAMPLE_COLUMNS}
    stamps = {c: c for c in (*schemas.INGEST_PARTITIONS, "ingestion_timestamp")}
    flat = pick(stored, {**wanted, **stamps})
    return settle(flat.withColumn("event_timestamp", iso_timestamp(F.col("event_timestamp"))))


@query("load_audit", "SELECT count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected, 'processed' AS status FROM lineitem")
def load_audit_totals(spark, d):
    source = _as_json(spark, d, scratch(spark, "landing"))
    audit = load_audit(landing.parse_landing(landing.landing_text(spark, source, glob=_TEXTS, shape=landing.LINES), schemas.EVENT))
    return audit.groupBy("status").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))


_LOT = "CAST(regexp_extract(event_id, '([0-9]+)$', 1) AS BIGINT) % 6"


@query("landing_rejects", f"""WITH {FLAT}, lots AS (SELECT event_id, {_LOT} AS lot FROM flat)
    SELECT event_id, CAST(NULL AS VARCHAR) AS reject_reason, CAST(1 AS BIGINT) AS n FROM lots WHERE lot NOT IN (1, 2, 3)
    UNION ALL SELECT NULL, CASE lot WHEN 1 THEN 'not_json' WHEN 2 THEN 'trailing_content' ELSE 'foreign_layout' END, count(*) FROM lots WHERE lot IN (1, 2, 3) GROUP BY lot
    UNION ALL SELECT 'audit', 'loaded', count(*) FROM lots WHERE lot NOT IN (1, 2, 3)
    UNION ALL SELECT 'audit', 'rejected', count(*) FROM lots WHERE lot IN (1, 2, 3)""")
def landing_rejects(spark, d):
    """Half of the lines broken: cut short, two records on a line, or of another layout. Nothing is lost: accepted ids, reasons, and the audit's sums."""
    lot = F.expr(_LOT)
    text = F.to_json(F.struct("*"))
    line = F.when(lot == 1, F.substring(text, 1, 40)).when(lot == 2, F.concat(text, F.lit(" "), text)).when(lot == 3, F.lit('{"other": {"layout": 1}}')).otherwise(text)
    path = scratch(spark, "broken")
    _write_text(events(spark, d).select(line.alias("value")), path)
    lines = jobs.without_used_text(landing.parse_landing(landing.landing_text(spark, path, glob=_TEXTS, shape=landing.LINES), schemas.EVENT))
    # Parsed once, as three outputs start from it; written down is what they are made of.
    parsed = settled(lines.select("event_id", "raw", "file_path", "file_size", "file_time", "reject_reason"), scratch(spark, "parsed"))
    good = landing.accepted(parsed).select("event_id", F.lit(None).cast("string").alias("reject_reason"), F.lit(1).cast("bigint").alias("n"))
    bad = landing.rejected(parsed).groupBy("reject_reason").agg(F.count("*").alias("n")).select(F.lit(None).cast("string").alias("event_id"), "reject_reason", "n")
    audit = load_audit(parsed).agg(F.sum("rows_loaded").alias("loaded"), F.sum("rows_rejected").alias("rejected"))
    sums = audit.select(F.lit("audit").alias("event_id"), F.expr("stack(2, 'loaded', loaded, 'rejected', rejected) AS (reject_reason, n)"))
    return good.unionByName(bad).unionByName(sums)


@query("required_keys", "SELECT o_orderkey FROM orders WHERE o_orderkey % 29 <> 0")
def required_keys(spark, d):
    gappy = table(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 29 != 0, F.col("o_orderkey")).alias("O_OrderKey"))
    usable, _ = require(gappy, ["o_orderkey"])
    return usable.select(F.col("O_OrderKey").alias("o_orderkey"))


@query("schema_evolution", """SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS p_brand FROM part""")
def schema_evolution(spark, d):
    """Older files lack a column that newer ones have."""
    path = scratch(spark, "evolving")
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    part.filter("p_partkey % 2 = 1").drop("p_brand").write.parquet(f"{path}/day=1")
    part.filter("p_partkey % 2 = 0").write.parquet(f"{path}/day=2")
    return landing.parquet_rows(spark, path, merge_schema=True).select("p_partkey", "p_name", "p_brand")


@query("catalog_roundtrip", f"WITH {ALERTS} SELECT car_chassis, alert_value, alert_type, event_year FROM alerts")
def catalog_roundtrip(spark, d):
    """External partitioned table over written files, found by partition discovery."""
    path, database = scratch(spark, "catalog"), f"wayfleet_{uuid.uuid4().hex[:8]}"
    files.append(alert_log(silver(events(spark, d), AS_OF)), path, schemas.MONTH_PARTITIONS)
    tables.create_external(spark, database, "alert_log", schemas.ALERT, path, schemas.MONTH_PARTITIONS)
    tables.discover_partitions(spark, database, "alert_log")
    return tables.table(spark, database, "alert_log").select("car_chassis", "alert_value", "alert_type", "event_year")


# --- sinks ----------------------------------------------------------------------------

_STATE_SAMPLE = "car_chassis, event_id, current_mileage_km, insurance_status, insurance_days_expired"


@query("publish_roundtrip", f"WITH {STATE} SELECT {_STATE_SAMPLE} FROM state")
def publish_roundtrip(spark, d):
    """Current state from two batches, the second merged into the published first."""
    root = scratch(spark, "state")
    rows = silver(events(spark, d), AS_OF).withColumn("first", F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0)
    # Written down are only the rows that may be a vehicle's latest in their batch.
    flat = settled(may_be_latest(rows, ["car_chassis", "first"], STATE_RECENCY, "event_id", event_parts(spark, d)), f"{root}-rows")
    for batch in (flat.filter("first").drop("first"), flat.filter("NOT first").drop("first")):
        stored = snapshots.current(spark, root, medallion.state_schema(spark))
        snapshots.publish(medallion.merge_current_state(batch, stored, AS_OF), root)
    return snapshots.current(spark, root).select(*(c.strip() for c in _STATE_SAMPLE.split(",")))


def _monthly_events(bronze: DataFrame) -> DataFrame:
    """Ids and vehicles of the dated Silver rows, by month; columns that are not kept are never worked out.

    Between copies of an event with equal moments the digest of the kept columns decides, not that of Silver's 47. Id and month
    are the same whichever stays.
    """
    kept = flatten_events(bronze).select("event_id", "car_chassis", *EVENT_RECENCY)
    once = one_row_per_event(kept).filter(F.col("event_timestamp").isNotNull())
    return once.withColumns(date_parts(F.col("event_timestamp"), "event")).select("event_id", "car_chassis", *schemas.MONTH_PARTITIONS)


@query("compaction_roundtrip", f"WITH {SILVER} SELECT event_year, event_month, count(*) AS n, count(*) AS seen FROM silver WHERE event_year IS NOT NULL GROUP BY ALL")
def compaction_roundtrip(spark, d):
    """Appends before and after a compaction: all rows stay, and a stream that goes on afterwards sees each row once."""
    out, months = scratch(spark, "compact"), schemas.MONTH_PARTITIONS
    path = f"{out}/table"
    flat = settled(_monthly_events(events(spark, d)), f"{out}/rows")
    lot = F.pmod(F.xxhash64("event_id"), F.lit(3))

    def stream_on() -> None:
        stream = parquet_stream(spark, path, flat.schema)
        drain(stream.writeStream.format("parquet").option("path", f"{out}/seen"), f"{out}/checkpoint")

    files.append(flat.filter(lot == 0), path, months)
    files.append(flat.filter(lot == 1), path, months)
    stream_on()
    files.compact(spark, path, flat.schema, months, F.col("event_year") >= "1998")
    files.append(flat.filter(lot == 2), path, months)
    stream_on()
    stored = spark.read.schema(flat.schema).parquet(path).groupBy(*months).agg(F.count("*").alias("n"))
    streamed = spark.read.schema(flat.schema).parquet(f"{out}/seen").groupBy(*months).agg(F.count("*").alias("seen"))
    return stored.join(streamed, months, "full_outer")


_FUEL_SQL = f"""WITH {FUEL} SELECT car_chassis, event_year, event_month, total_mileage, total_fuel, trip_count,
    {rounded('avg_speed', 9)} AS avg_speed, max_speed FROM fuel"""
_FUEL_COLUMNS = ("car_chassis", "event_year", "event_month", "total_mileage", "total_fuel", "trip_count", "avg_speed",
                 "max_speed")


@query("fuel_batches_roundtrip", _FUEL_SQL)
def fuel_batches_roundtrip(spark, d):
    """Batches applied, folded, applied twice: totals stay those of one pass."""
    root, layout = scratch(spark, "fuel"), jobs.partials_schema(spark)
    lot = F.pmod(F.xxhash64("event_id"), F.lit(3)).cast("byte")
    # Only what the totals need is written down, and the lot in place of the id.
    flat = settled(dated(silver(events(spark, d), AS_OF)).select(*monthly.INPUTS, lot.alias("lot")), f"{root}-rows")
    for i in (0, 1):
        batches.apply_batch(monthly.partials(flat.filter(F.col("lot") == i)), root, str(i))
    batches.fold(spark, root, layout, monthly.merge, schemas.MONTH_PARTITIONS)
    for i in (2, 1, 2):
        batches.apply_batch(monthly.partials(flat.filter(F.col("lot") == i)), root, str(i))
    return settle(monthly.finish(batches.merged(spark, root, layout, monthly.merge)).select(*_FUEL_COLUMNS), 9)


# --- streams --------------------------------------------------------------------------

@query("stream_equals_batch", f"""SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n,
    {rounded('CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE)', 2)} AS total FROM events GROUP BY ALL""")
def stream_equals_batch(spark, d):
    """Events consumed by an availableNow stream, then summed."""
    out = scratch(spark, "stream")
    stream = parquet_stream(spark, d, table(spark, d, "events").schema, glob="events.parquet")
    drain(stream.writeStream.format("parquet").option("path", f"{out}/data"), f"{out}/checkpoint")
    stored = spark.read.parquet(f"{out}/data")
    return stored.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("stream_first_delivery", "SELECT event_id, user_id FROM events")
def stream_first_delivery(spark, d):
    """The same events delivered twice; the stream lets one of each through."""
    out = scratch(spark, "twice")
    rows = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    rows.write.parquet(f"{out}/in")
    rows.write.mode("append").parquet(f"{out}/in")
    stream = parquet_stream(spark, f"{out}/in", rows.schema)
    once = jobs.first_delivery(stream, "event_id", "ts", "1 hour")
    drain(once.writeStream.format("parquet").option("path", f"{out}/data"), f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data").select("event_id", "user_id")


def _live_silver(spark: SparkSession, d: str, out: str, after=lambda feed: None) -> str:
    """Silver from three batches with copies of an event apart, so that later ones rewrite days; ``after`` runs after each. The change feed's folder."""
    bronze, at = f"{out}/bronze", F.lit("1998-09-02 06:00:00").cast("timestamp")
    rows = settled(to_bronze(events(spark, d, folded=True, in_order=True).withColumn("file_path", F.lit("feed")), at), f"{out}/rows")
    # A third of the events come a second time, first with another distance and, half of them, on another day.
    again = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    wrong = F.col("trip_data").withField("trip_summary.data.tripMileage", F.lit(1e6)).withField("vehicle_telemetry_snapshot.data.engineTempCelsius", F.lit(150).cast("bigint"))
    moved = F.when(F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0, "2024-01-01T00:00:00Z").otherwise(F.col("event_primary_timestamp"))
    early = rows.filter(again & F.col("event_primary_timestamp").rlike("^2024-01-2.*Z$")).withColumns({
        "trip_data": wrong, "event_primary_timestamp": moved, "processing_timestamp": F.lit("2000-01-01T00:00:00Z")})
    lot = F.pmod(F.xxhash64("event_id", "processing_timestamp", "carChassis"), F.lit(2)) + 1
    for i in range(3):
        files.append_load(early if i == 0 else rows.filter(lot == i), bronze, schemas.INGEST_PARTITIONS, i, as_read=True, codec=files.PACKED)
        jobs.refresh_silver(spark, bronze, f"{out}/silver", f"{out}/undated", f"{out}/deltas", f"{out}/checkpoint", AS_OF, feed=f"{out}/changes")
        after(f"{out}/changes")
    return f"{out}/changes"


@query("silver_any_batching", f"""WITH {folded_sql(SILVER)} SELECT event_id, car_chassis, current_mileage_km, trip_distance_km, event_year, event_month, event_day
    FROM silver WHERE event_year IS NOT NULL""")
def silver_any_batching(spark, d):
    """Silver from deliveries dealt over several batches, copies of an event apart, some on another day: the same as from one pass."""
    out = scratch(spark, "batches")
    _live_silver(spark, d, out)
    stored = spark.read.schema(jobs.silver_schema(spark)).parquet(f"{out}/silver")
    return stored.select("event_id", "car_chassis", "current_mileage_km", "trip_distance_km", *schemas.EVENT_PARTITIONS)


@query("change_feed", f"""WITH {folded_sql(SILVER)} SELECT event_id, car_chassis, trip_distance_km, event_year, event_month, event_day, CAST(1 AS BIGINT) AS net
    FROM silver WHERE event_year IS NOT NULL""")
def change_feed(spark, d):
    """All signed rows of the feed, netted: every event of Silver once, what was withdrawn is gone."""
    feed = _live_silver(spark, d, scratch(spark, "feed"))
    rows = spark.read.schema(changes.feed_schema(jobs.silver_schema(spark))).parquet(feed)
    net = rows.groupBy("event_id", "car_chassis", "trip_distance_km", *schemas.EVENT_PARTITIONS).agg(F.sum(changes.SIGN).alias("net"))
    return net.filter("net <> 0")


@query("stream_alert_log", f"WITH {folded_sql(ALERTS)} SELECT * FROM alerts WHERE event_year IS NOT NULL")
def stream_alert_log(spark, d):
    """Alerts of a Silver that is rewritten meanwhile: the feed's stream runs after every batch and takes back what went."""
    out, layout = scratch(spark, "alerts"), jobs.silver_schema(spark)
    _live_silver(spark, d, out, lambda feed: changes.log_alerts(spark, feed, layout, f"{out}/alerts", f"{out}/alerts-checkpoint"))
    return settle(changes.read_alerts(spark, f"{out}/alerts"))


@query("stream_fuel_monthly", folded_sql(_FUEL_SQL))
def stream_fuel_monthly(spark, d):
    """Monthly totals of a Silver that is rewritten meanwhile, from the feed, after every batch, with a fold in between."""
    out, layout = scratch(spark, "fuelstream"), jobs.silver_schema(spark)
    _live_silver(spark, d, out, lambda feed: changes.accumulate_fuel(spark, feed, layout, f"{out}/fuel", f"{out}/fuel-checkpoint", fold_every=2))
    return settle(monthly.finish(changes.read_fuel(spark, f"{out}/fuel", layout)).select(*_FUEL_COLUMNS), 9)


@query("landing_to_products", f"WITH {state_sql('silver WHERE event_year IS NOT NULL', folded=True)} SELECT {_STATE_SAMPLE} FROM state")
def landing_to_products(spark, d):
    """The whole flow from text files to the published current state."""
    root = scratch(spark, "flow")
    layout = medallion.Layout(_as_json(spark, d, f"{root}/landing", folded=True), f"{root}/lake")
    jobs.land_bronze(spark, layout.landing, layout.bronze, layout.quarantine, layout.audit,
                     layout.checkpoint("bronze"), glob=_TEXTS, shape=landing.LINES)
    medallion.build(spark, layout, AS_OF)
    return medallion.read_state(spark, layout).select(*(c.strip() for c in _STATE_SAMPLE.split(",")))


@query("rebuilt_generation", f"""WITH {folded_sql(ALERTS)}, sums AS (SELECT (SELECT count(*) FROM silver WHERE event_year IS NOT NULL) AS silver_rows,
      (SELECT count(*) FROM alerts WHERE event_year IS NOT NULL) AS alert_rows)
    SELECT g AS generation, silver_rows, alert_rows, 55 AS silver_columns, silver_rows AS stored_rows, alert_rows AS stored_alerts FROM sums, (VALUES ('g1'), ('g2')) v(g)""")
def rebuilt_generation(spark, d):
    """Run summaries of a flow and of its rebuild from the same Bronze into another generation, beside what their tables hold."""
    root = scratch(spark, "rebuilt")
    first = medallion.Layout(_as_json(spark, d, f"{root}/landing", folded=True), f"{root}/lake")
    jobs.land_bronze(spark, first.landing, first.bronze, first.quarantine, first.audit, first.checkpoint("bronze"), glob=_TEXTS, shape=landing.LINES)
    found = None
    for layout in (first, first.rebuilt("g2")):
        medallion.build(spark, layout, AS_OF)
        stored = medallion.read_silver(spark, layout).agg(F.count("*").alias("n")).scalar()
        alerts = medallion.read_alerts(spark, layout).agg(F.count("*").alias("n")).scalar()
        runs = spark.read.parquet(layout.runs).groupBy("silver_columns").agg(F.sum("silver_rows").alias("silver_rows"), F.sum("alert_rows").alias("alert_rows"))
        rows = runs.select(F.lit(layout.generation).alias("generation"), "silver_rows", "alert_rows", "silver_columns", stored.alias("stored_rows"), alerts.alias("stored_alerts"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query("bronze_lineage", f"""WITH {FLAT}, lots AS (SELECT event_id, {_LOT} AS lot FROM flat)
    SELECT event_id, concat('s3a://fleet-', CAST(lot % 2 AS VARCHAR), '/in/a b/', CAST(lot AS VARCHAR), '.json') AS source_file,
      concat('fleet-', CAST(lot % 2 AS VARCHAR)) AS source_bucket, '1998' AS ingest_year, '09' AS ingest_month, '02' AS ingest_day FROM lots""")
def bronze_lineage(spark, d):
    """File and bucket of every event in Bronze, names decoded, and the day its file arrived."""
    lot = F.expr(_LOT)
    path = F.concat(F.lit("s3a://fleet-"), (lot % 2).cast("string"), F.lit("/in/a%20b/"), lot.cast("string"), F.lit(".json"))
    rows = events(spark, d).withColumns({"file_path": path, "file_size": F.lit(1), "file_time": F.lit("1998-09-02 23:59:59").cast("timestamp")})
    return to_bronze(rows).select("event_id", "source_file", "source_bucket", *schemas.INGEST_PARTITIONS)
