"""The change feed of a table: what every batch added and withdrew, as signed rows.

A table whose days are rewritten is no source for a stream: a rewritten file looks like new data. The feed is one. Each
batch adds a folder with the rows that came (sign 1) and the rows that went (sign -1), and never touches it
again. Whatever folds signed rows follows the table exactly, retractions included:
sums and counts directly, a maximum through signed counts of its values, a log by netting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from wayfleet import schemas
from wayfleet.functions.alerts import SLIM_RULES, Rule
from wayfleet.operators.latest import content_hash
from wayfleet.operators.monthly import ATTRIBUTES, VEHICLE_MONTH, usable
from wayfleet.operators.upsert import by_name
from wayfleet.plans.gold import alert_log
from wayfleet.sinks.batches import apply_batch, fold, merged
from wayfleet.sinks.files import write_once
from wayfleet.streaming.sources import drain, parquet_stream

SIGN = "change"


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows that lead from one table to another with the same columns; copies of a row count.

    One aggregation over both sides; rows on both sides cancel, on the map side already where they meet.
    """
    columns = after.columns
    both = before.select(*columns, F.lit(-1).alias(SIGN)).unionByName(after.select(*columns, F.lit(1).alias(SIGN)))
    net = both.groupBy(*columns).agg(F.sum(SIGN).cast("int").alias(SIGN))
    return net.filter(F.col(SIGN) != 0)


# The sign of a batch's rows that have no place in the table.
APART = 2


def merged_changes(before: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str], apart: Column | None = None) -> DataFrame:
    """The latest row per key of a table and a batch, signed 1 if it comes and 0 if it is there already, and the rows that go, signed -1.

    One pass over both sides: rows signed 0 or 1 are the table afterwards, those signed 1 or -1 are its ``difference``. Where a row
    of the batch equals one that is there, the latter stays. Rows of the batch for which ``apart`` holds take no part and are signed 2.
    """
    columns = before.columns
    both = before.select(*columns, F.lit(-1).alias(SIGN)).unionByName(new.select(*columns, F.lit(1).alias(SIGN)))
    aside = F.lit(False) if apart is None else F.coalesce((F.col(SIGN) > 0) & apart, F.lit(False))
    ranking = [] if apart is None else [aside.asc()]
    ranking += [F.col(o).desc_nulls_last() for o in order] + [content_hash(before).desc(), F.col(SIGN).asc()]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking)) == 1
    signed = both.withColumn("_first", first).withColumn(
        SIGN, F.when(aside, APART).when(F.col("_first"), F.when(F.col(SIGN) < 0, 0).otherwise(1)).when(F.col(SIGN) < 0, -1))
    return signed.filter(F.col(SIGN).isNotNull()).select(*columns, SIGN)


def came(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col(SIGN) > 0).drop(SIGN)


def went(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col(SIGN) < 0).drop(SIGN)


def publish(changes: DataFrame, feed: str, batch: str) -> None:
    """Add a batch to the feed. The folder appears whole, by one rename, and a repetition finds it there."""
    write_once(changes, published(feed, batch), as_read=True)


def published(feed: str, batch: str) -> str:
    """The folder of a batch in the feed."""
    return f"{feed.rstrip('/')}/batch={batch}"


def feed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SIGN, T.IntegerType())])


def change_stream(spark: SparkSession, feed: str, schema: T.StructType, **options) -> DataFrame:
    """Signed rows of the feed as they arrive; ``schema`` is the table's."""
    return parquet_stream(spark, feed, feed_schema(schema), **options)


# --- monthly fuel ---------------------------------------------------------------------

# Sums are kept as decimals, so that what is withdrawn cancels exactly what was added.
_EXACT = "decimal(38,9)"
_SUMS = {
    "total_mileage": "trip_distance_km", "total_fuel": "trip_fuel_consumed_liters", "trip_count": "1",
    "speed_sum": "trip_max_speed_kmh", "speed_rows": "CAST(trip_max_speed_kmh IS NOT NULL AS INT)",
    "duration_sum": "trip_duration_minutes", "duration_rows": "CAST(trip_duration_minutes IS NOT NULL AS INT)",
    "l_per_100km_sum": "fuel_efficiency_l_per_100km", "l_per_100km_rows": "CAST(fuel_efficiency_l_per_100km IS NOT NULL AS INT)",
}
_VALUE = ("speed", "event_day", *ATTRIBUTES)


def _signed(name: str) -> Column:
    return F.sum(F.col(name).cast(_EXACT) * F.col(SIGN)).cast(_EXACT).alias(name)


def signed_fuel(changes: DataFrame, keys: Sequence[str] = VEHICLE_MONTH) -> DataFrame:
    """Mergeable monthly rows of signed telemetry, of three kinds.

    ``sums`` has the signed sums of a vehicle's month, ``speed`` how often each top speed occurs in it, and ``described`` how often
    each description occurs on each of its days: as many rows as there are distinct values, so a maximum survives the loss of its row.
    """
    clean = usable(changes, keys, ["trip_distance_km", "trip_fuel_consumed_liters"])
    rows = clean.select(
        *keys, F.col("event_day"), *ATTRIBUTES, F.col("trip_max_speed_kmh").cast("double").alias("speed"), SIGN,
        *(F.expr(source).alias(name) for name, source in _SUMS.items()))
    nothing = {c: F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in _VALUE}
    sums = rows.groupBy(*keys).agg(*map(_signed, _SUMS)).select(
        *keys, F.lit("sums").alias("kind"), *nothing.values(), F.lit(0).cast("bigint").alias("n"), *_SUMS)

    def counts(kind: str, *of: str) -> DataFrame:
        found = rows.groupBy(*keys, *of).agg(F.sum(SIGN).cast("bigint").alias("n"))
        return found.select(
            *keys, F.lit(kind).alias("kind"), *(F.col(c) if c in of else nothing[c] for c in _VALUE), "n",
            *(F.lit(0).cast(_EXACT).alias(name) for name in _SUMS))

    speeds = counts("speed", "speed").filter("speed IS NOT NULL")
    return sums.unionByName(speeds).unionByName(counts("described", "event_day", *ATTRIBUTES))


def merge_fuel(*frames: DataFrame, keys: Sequence[str] = VEHICLE_MONTH) -> DataFrame:
    """Any number of such tables in one; values that no row has any more are gone."""
    together = by_name(*frames).groupBy(*keys, "kind", *_VALUE).agg(
        F.sum("n").alias("n"), *(F.sum(name).cast(_EXACT).alias(name) for name in _SUMS))
    return together.filter("(kind = 'sums' AND trip_count <> 0) OR n <> 0")


def finished_partials(signed: DataFrame, keys: Sequence[str] = VEHICLE_MONTH) -> DataFrame:
    """The columns that ``monthly.finish`` reads, from merged signed rows.

    A month is described as on its last day with a trip; of several descriptions on that day the largest stands.
    """
    of_kind = lambda kind, c: F.when(F.col("kind") == kind, c)
    described = F.max(of_kind("described", F.struct("event_day", *ATTRIBUTES)))
    wide = signed.groupBy(*keys).agg(
        *(F.sum(name).alias(name) for name in _SUMS), F.max(of_kind("speed", F.col("speed"))).alias("max_speed"), described.alias("_described"))
    whole = ("trip_count", "speed_rows", "duration_rows", "l_per_100km_rows")
    return wide.filter("trip_count > 0").select(
        *keys, *(F.col(name).cast("bigint" if name in whole else "double").alias(name) for name in _SUMS), "max_speed",
        *(F.col(f"_described.{name}").alias(name) for name in ATTRIBUTES))


def fuel_schema(spark: SparkSession, schema: T.StructType) -> T.StructType:
    return signed_fuel(schemas.empty(spark, feed_schema(schema))).schema


def accumulate_fuel(spark: SparkSession, feed: str, schema: T.StructType, fuel: str, checkpoint: str, fold_every: int = 50,
                    **source_options) -> StreamingQuery:
    """Change feed -> monthly signed rows, one repeatable folder per micro-batch. Late events and retractions reach their own, possibly old, month.

    Every ``fold_every`` batches the folders so far become one table, in which values that no row has any more are gone.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        apply_batch(signed_fuel(batch), fuel, str(batch_id))
        if (batch_id + 1) % fold_every == 0:
            fold(batch.sparkSession, fuel, fuel_schema(batch.sparkSession, schema), merge_fuel, schemas.MONTH_PARTITIONS)

    stream = change_stream(spark, feed, schema, **source_options)
    return drain(stream.writeStream.foreachBatch(load), checkpoint)


def read_fuel(spark: SparkSession, fuel: str, schema: T.StructType) -> DataFrame:
    """Monthly partials as the feed has them so far; ``monthly.finish`` makes the published table of them."""
    return finished_partials(merged(spark, fuel, fuel_schema(spark, schema), merge_fuel))


# --- alerts ---------------------------------------------------------------------------

def log_alerts(spark: SparkSession, feed: str, schema: T.StructType, alerts: str, checkpoint: str,
               rules: Sequence[Rule] = SLIM_RULES, **source_options) -> StreamingQuery:
    """Change feed -> signed alert log: stateless, written by the exactly-once file sink. A withdrawn event withdraws its alert."""
    rows = change_stream(spark, feed, schema, **source_options)
    raised = alert_log(rows.filter(F.col(SIGN) > 0), rules).withColumn(SIGN, F.lit(1))
    taken_back = alert_log(rows.filter(F.col(SIGN) < 0), rules).withColumn(SIGN, F.lit(-1))
    writer = (
        raised.unionByName(taken_back).writeStream.format("parquet").outputMode("append").option("path", alerts)
        .partitionBy(*schemas.ALERT_PARTITIONS)
    )
    return drain(writer, checkpoint)


def read_alerts(spark: SparkSession, alerts: str) -> DataFrame:
    """The alerts that stand: the log netted, each as often as it was raised and not taken back."""
    columns = schemas.ALERT.names
    log = spark.read.schema(feed_schema(schemas.ALERT)).parquet(alerts)
    net = log.groupBy(*columns).agg(F.sum(SIGN).cast("int").alias("n")).filter("n > 0")
    return net.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select(*columns)
