"""The whole flow in data order: landing, Bronze, Silver, then the three products."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wayfleet import schemas
from wayfleet.functions import alerts
from wayfleet.functions.clock import AsOf
from wayfleet.operators import monthly
from wayfleet.operators.latest import latest_per_key
from wayfleet.operators.summary import violation_rate
from wayfleet.operators.upsert import not_yet_stored, within_partitions
from wayfleet.plans.gold import alert_log, current_state, merge_current_state
from wayfleet.plans.silver import EVENT_RECENCY
from wayfleet.sinks import snapshots
from wayfleet.sinks.files import append_load, refresh_partitions
from wayfleet.sources.landing import DOCUMENTS
from wayfleet.sources.tables import folder_or_empty
from wayfleet.streaming import jobs


@dataclass(frozen=True)
class Layout:
    """Where things live. ``generation`` separates rebuilds of everything after Bronze."""

    landing: str
    root: str
    generation: str = "g1"

    def _at(self, *steps: str) -> str:
        return "/".join([self.root.rstrip("/"), *steps])

    bronze = property(lambda self: self._at("bronze"))
    quarantine = property(lambda self: self._at("quarantine"))
    audit = property(lambda self: self._at("audit"))
    silver = property(lambda self: self._at(self.generation, "silver"))
    undated = property(lambda self: self._at(self.generation, "undated"))
    deltas = property(lambda self: self._at(self.generation, "deltas"))
    changes = property(lambda self: self._at(self.generation, "changes"))
    ids = property(lambda self: self._at(self.generation, "event_ids"))
    state = property(lambda self: self._at(self.generation, "current_state"))
    fuel = property(lambda self: self._at(self.generation, "fuel_monthly"))
    alerts = property(lambda self: self._at(self.generation, "alerts"))
    runs = property(lambda self: self._at(self.generation, "runs"))

    def checkpoint(self, job: str) -> str:
        scope = "shared" if job == "bronze" else self.generation
        return self._at("_checkpoints", scope, job)

    def rebuilt(self, generation: str) -> Layout:
        """The same landing and Bronze, everything else from scratch."""
        return replace(self, generation=generation)


def state_schema(spark: SparkSession) -> T.StructType:
    return jobs.layout_of("state", lambda: current_state(schemas.empty(spark, jobs.silver_schema(spark))))


def refresh_products(change: jobs.Change, batch_id: int, layout: Layout, as_of: AsOf = None,
                     rules=alerts.SLIM_RULES) -> None:
    """Bring the three products in line with what a batch did to Silver, and write down the run summary.

    Monthly totals and alerts are computed anew for the months and days that were touched, from
    Silver as it is now, and the state for vehicles that lost a row. So every step may be repeated for
    the same batch, and the products do not depend on how deliveries are dealt over batches.
    """
    spark = change.added.sparkSession
    stored = read_silver(spark, layout)
    months = change.days.select(*schemas.MONTH_PARTITIONS).distinct()
    refresh_partitions(
        monthly.partials(within_partitions(stored, months, schemas.MONTH_PARTITIONS)), layout.fuel, schemas.MONTH_PARTITIONS, months)
    today = within_partitions(stored, change.days, schemas.EVENT_PARTITIONS)
    refresh_partitions(
        alert_log(today, rules), layout.alerts, schemas.ALERT_PARTITIONS,
        within_partitions(read_alerts(spark, layout), change.days, schemas.EVENT_PARTITIONS))

    state = snapshots.current(spark, layout.state, state_schema(spark))
    fresh = change.added
    if not change.bereft.isEmpty():
        # A vehicle that lost a row is looked up in all of Silver; this is rare.
        fresh = fresh.unionByName(stored.join(change.bereft, "car_chassis", "left_semi"))
        state = state.join(change.bereft, "car_chassis", "left_anti").select(*state.columns)
    snapshots.publish(merge_current_state(fresh, state, as_of), layout.state)

    append_load(run_summary(change.added, batch_id, rules), layout.runs, [], change.name)


def run_summary(delta: DataFrame, batch_id: int, rules=alerts.SLIM_RULES) -> DataFrame:
    """One row about a batch: rows, alerts, alert rate, width, time."""
    figures = violation_rate(delta, alerts.any_fired(rules))
    return figures.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("total_rows").alias("silver_rows"),
        "alert_rows",
        "violation_rate_pct",
        F.lit(len(delta.columns)).alias("silver_columns"),
        F.current_timestamp().alias("finished_at"),
    )


def run(spark: SparkSession, layout: Layout, as_of: AsOf = None, clean: str = "off",
        files_per_batch: int | None = None, shape: str = DOCUMENTS) -> None:
    """Process everything that arrived since the last run. A run without input is a no-op."""
    jobs.land_bronze(
        spark, layout.landing, layout.bronze, layout.quarantine, layout.audit, layout.checkpoint("bronze"),
        clean=clean, files_per_batch=files_per_batch, shape=shape,
    )
    build(spark, layout, as_of, files_per_batch)


def build(spark: SparkSession, layout: Layout, as_of: AsOf = None, files_per_batch: int | None = None) -> None:
    """Bronze -> products only; with a new ``generation`` this reprocesses all of Bronze."""
    jobs.refresh_silver(
        spark, layout.bronze, layout.silver, layout.undated, layout.deltas, layout.checkpoint("silver"), as_of,
        then=lambda change, batch_id: refresh_products(change, batch_id, layout, as_of),
        feed=layout.changes, index=layout.ids, files_per_batch=files_per_batch,
    )


def read_silver(spark: SparkSession, layout: Layout) -> DataFrame:
    return folder_or_empty(spark, layout.silver, jobs.silver_schema(spark))


def read_state(spark: SparkSession, layout: Layout) -> DataFrame:
    return snapshots.current(spark, layout.state, state_schema(spark))


def read_undated(spark: SparkSession, layout: Layout) -> DataFrame:
    """Events without a usable time, each once; one that also came with a time is in Silver alone."""
    kept = folder_or_empty(spark, layout.undated, jobs.silver_schema(spark))
    return not_yet_stored(latest_per_key(kept, ["event_id"], EVENT_RECENCY), read_silver(spark, layout), ["event_id"])


def read_fuel(spark: SparkSession, layout: Layout) -> DataFrame:
    return monthly.finish(folder_or_empty(spark, layout.fuel, jobs.partials_schema(spark)))


def read_alerts(spark: SparkSession, layout: Layout) -> DataFrame:
    return folder_or_empty(spark, layout.alerts, schemas.ALERT)
