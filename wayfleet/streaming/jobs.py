"""Streaming counterparts of the plans. Each call processes what has arrived since
the previous call with the same checkpoint, then stops (``availableNow``)."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from wayfleet import schemas
from wayfleet.operators import monthly
from wayfleet.operators.upsert import within_partitions
from wayfleet.plans.bronze import load_audit, to_bronze
from wayfleet.plans.silver import EVENT_RECENCY, dated, event_days, silver, undated
from wayfleet.sinks import idindex
from wayfleet.sinks.files import PACKED, append_load, folder_names, materialise_once, move_once, refresh_partitions, remove, settings, write_apart
from wayfleet.sources.landing import accepted, rejected
from wayfleet.sources.tables import folder_exists, folder_or_empty, parts_for
from wayfleet.streaming.changes import APART, SIGN, came, feed_schema, merged_changes, publish, published, went
from wayfleet.streaming.sources import drain, landing_stream, parquet_stream


# Records are sorted, or made into a file, by the task that reads them, where each takes fifteen times the room that it has in a
# packed file. A stream keeps the setting that it is started with.
SPLITS = {"spark.sql.files.maxPartitionBytes": "16m"}

_LAYOUTS: dict[str, T.StructType] = {}


def layout_of(name: str, plan: Callable[[], DataFrame]) -> T.StructType:
    """Columns a plan produces. They depend on the code only, so they are worked out once."""
    if name not in _LAYOUTS:
        _LAYOUTS[name] = plan().schema
    return _LAYOUTS[name]


def silver_schema(spark: SparkSession) -> T.StructType:
    return layout_of("silver", lambda: silver(schemas.empty(spark, schemas.BRONZE)))


def partials_schema(spark: SparkSession) -> T.StructType:
    return layout_of("partials", lambda: monthly.partials(schemas.empty(spark, silver_schema(spark))))


def without_used_text(parsed: DataFrame) -> DataFrame:
    """Text only where it was refused; beside a record it would be most of what is held, and nobody reads it."""
    return parsed.withColumn("raw", F.when(F.col("reject_reason").isNotNull(), F.col("raw")))


def land_bronze(spark: SparkSession, landing: str, bronze: str, quarantine: str, audit: str, checkpoint: str,
                **source_options) -> StreamingQuery:
    """Landing files -> Bronze, with rejects kept as text and one audit row per file."""

    def load(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # Three outputs from one parse, written down meanwhile: held in memory, nested records take many times the room, in blocks
        # as large as the landing files.
        session, at = batch.sparkSession, f"{checkpoint.rstrip('/')}_parsed/batch={batch_id}"
        parsed = without_used_text(batch)
        parsed.write.mode("overwrite").option("compression", PACKED).parquet(at)
        parsed = session.read.schema(parsed.schema).parquet(at)
        append_load(to_bronze(accepted(parsed)), bronze, schemas.INGEST_PARTITIONS, batch_id, as_read=True, codec=PACKED)
        append_load(rejected(parsed), quarantine, [], batch_id)
        append_load(load_audit(parsed), audit, [], batch_id)
        remove(session, at)

    stream = landing_stream(spark, landing, schemas.EVENT, **source_options)
    with settings(spark, SPLITS):
        return drain(stream.writeStream.foreachBatch(load), checkpoint)


@dataclass(frozen=True)
class Change:
    """What a batch did to Silver, written down: rows it added, vehicles that lost a row, and the days it rewrote."""

    name: str
    added: DataFrame
    bereft: DataFrame
    days: DataFrame


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id Spark gave the stream when its checkpoint began; a new checkpoint has another one."""
    if not folder_exists(spark, f"{checkpoint}/metadata"):
        return None
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def refresh_silver(spark: SparkSession, bronze: str, silver_path: str, undated_path: str, deltas: str,
                   checkpoint: str, as_of=None, then: Callable[[Change, int], None] | None = None,
                   feed: str | None = None, index: str | None = None, **source_options) -> StreamingQuery:
    """Bronze -> Silver: each event once, its latest copy, however copies are dealt over batches.

    A batch is merged with the days it touches: those of its own rows and those where older copies of its
    events are stored, which an ``index`` of event ids tells without a look at Silver. The latest copy of an event wins, and moves
    it to another day if its time has changed. Everything the batch changes is written down first (``deltas``);
    the change ``feed``, the index, Silver and whatever ``then`` does are fed from there, so a retried batch does the same again.
    What is written down carries the checkpoint's id: a new checkpoint never takes an older one's batch for its own, but
    first finishes what that one had written down.
    """
    layout, day = silver_schema(spark), schemas.EVENT_PARTITIONS
    feed, index = feed or f"{silver_path.rstrip('/')}_changes", index or f"{silver_path.rstrip('/')}_ids"
    signed = feed_schema(layout)

    def plan(batch: DataFrame, at: str) -> None:
        session = batch.sparkSession
        new_days = materialise_once(event_days(batch), f"{at}/new_days")
        days = materialise_once(touched_days(new_days), f"{at}/days")
        if any(folder_exists(session, f"{at}/{t}/_SUCCESS") for t in ("signed", "merged", "changes")):
            return  # Written down already, the last two by older releases.
        before = within_partitions(folder_or_empty(session, silver_path, layout), days, day).select(*layout.names)
        new = silver(batch, as_of).select(*layout.names)
        # Rows of the batch are moved once, by their id: stored ones are dealt out alike, over tasks that adaptive execution
        # does not size for both.
        parts = parts_for(2 * (new_days.count() + before.count()), session.sparkContext.defaultParallelism)
        signs = merged_changes(before.repartition("event_id"), new, ["event_id"], EVENT_RECENCY, apart=F.col(day[0]).isNull())
        kind = F.when(F.col(SIGN) == 0, "kept").when(F.col(SIGN) == APART, "undated").otherwise("changes")
        with settings(session, {"spark.sql.shuffle.partitions": parts}):
            write_apart(signs.withColumn("kind", kind), f"{at}/signed", "kind")

    def touched_days(new: DataFrame) -> DataFrame:
        """The days of the batch's events and of their older copies."""
        older = idindex.lookup(new.select("event_id"), index, idindex.DAYS).select(*day)
        return dated(older.unionByName(new.select(*day))).distinct()

    def outcome(session: SparkSession, at: str, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The touched days after the batch, the signed rows that lead there, as published, and its undated rows."""
        read = lambda path, schema: folder_or_empty(session, path, schema)
        if folder_exists(session, f"{at}/changes/_SUCCESS"):
            # Written down when these were two tables.
            publish(read(f"{at}/changes", signed), feed, name)
            return read(f"{at}/after", layout), read(f"{at}/changes", signed), undated(read(f"{at}/new", layout))
        if folder_exists(session, f"{at}/merged/_SUCCESS"):
            # Written down when the published rows were a copy.
            merged = read(f"{at}/merged", signed)
            changes = merged.filter(F.col(SIGN) != 0)
            publish(changes, feed, name)
            return merged.filter(F.col(SIGN) >= 0).drop(SIGN), changes, undated(read(f"{at}/new", layout))
        folder = f"{at}/signed/kind=changes"
        if folder_exists(session, folder):
            move_once(session, folder, published(feed, name))
        else:
            # Moved before the batch was repeated, or there are none.
            publish(schemas.empty(session, signed), feed, name)
        changes = read(published(feed, name), signed)
        kept, aside = (read(f"{at}/signed/kind={k}", signed).drop(SIGN) for k in ("kept", "undated"))
        return came(changes).unionByName(kept), changes, aside

    def apply(session: SparkSession, at: str, name: str, batch_id: int) -> None:
        after, changes, aside = outcome(session, at, name)
        days = session.read.schema(T.StructType([layout[c] for c in day])).parquet(f"{at}/days")
        idindex.record_load(came(changes).select(*idindex.DAYS.names), index, name)
        refresh_partitions(after, silver_path, day, days)
        append_load(aside, undated_path, [], name)
        if then is not None:
            then(Change(name, came(changes), went(changes).select("car_chassis").distinct(), days), batch_id)

    def load(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        session = batch.sparkSession
        stream = _checkpoint_id(session, checkpoint)
        at = f"{deltas}/{stream}/batch={batch_id}"
        # Batch n only starts once batch n - 1 is committed, so that copy is done with.
        remove(session, f"{deltas}/{stream}/batch={batch_id - 1}")
        plan(batch, at)
        apply(session, at, f"{stream}-{batch_id}", batch_id)

    current = _checkpoint_id(spark, checkpoint)
    for stream in folder_names(spark, deltas):
        if stream != current:
            # All but its newest batch are committed; that one may have stopped anywhere, and to repeat it does no harm.
            numbers = [int(n.removeprefix("batch=")) for n in folder_names(spark, f"{deltas}/{stream}")]
            done = lambda n: any(folder_exists(spark, f"{deltas}/{stream}/batch={n}/{t}/_SUCCESS") for t in ("signed", "merged", "changes"))
            for number in filter(done, sorted(numbers)[-1:]):
                apply(spark, f"{deltas}/{stream}/batch={number}", f"{stream}-{number}", number)
            remove(spark, f"{deltas}/{stream}")
    if folder_exists(spark, silver_path) and not folder_exists(spark, index):
        # Silver of a time without an index.
        idindex.record_load(folder_or_empty(spark, silver_path, layout).select(*idindex.DAYS.names), index, "base")
    stream = parquet_stream(spark, bronze, schemas.BRONZE, **source_options)
    with settings(spark, SPLITS):
        return drain(stream.writeStream.foreachBatch(load), checkpoint)


def first_delivery(stream: DataFrame, key: str, ts: str, within: str = "1 hour") -> DataFrame:
    """Streaming dedup with bounded state: keeps the first delivery of each key.

    Copies further apart than ``within`` may pass; the Silver job settles those.
    """
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])
