"""Monthly totals per vehicle, kept in a form that can be merged at any time.

The table stores *partials*: sums, counts, maxima and the moment a description
was last seen. Merging partials is associative and commutative, hence one batch,
many batches and reordered batches give the same totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.functions.ratios import km_per_litre
from wayfleet.operators.upsert import by_name

VEHICLE_MONTH = ("car_chassis", "event_year", "event_month")

# name of the partial -> (how to merge it, what it is computed from)
PARTIALS: dict[str, tuple[str, str]] = {
    "total_mileage": ("sum", "trip_distance_km"),
    "total_fuel": ("sum", "trip_fuel_consumed_liters"),
    "trip_count": ("sum", "1L"),
    "speed_sum": ("sum", "CAST(trip_max_speed_kmh AS DOUBLE)"),
    "speed_rows": ("sum", "CAST(trip_max_speed_kmh IS NOT NULL AS BIGINT)"),
    "max_speed": ("max", "CAST(trip_max_speed_kmh AS DOUBLE)"),
    "duration_sum": ("sum", "CAST(trip_duration_minutes AS DOUBLE)"),
    "duration_rows": ("sum", "CAST(trip_duration_minutes IS NOT NULL AS BIGINT)"),
    "l_per_100km_sum": ("sum", "fuel_efficiency_l_per_100km"),
    "l_per_100km_rows": ("sum", "CAST(fuel_efficiency_l_per_100km IS NOT NULL AS BIGINT)"),
}
ATTRIBUTES = ("manufacturer", "model")
_SEEN = "described_at"
# All that ``partials`` reads.
INPUTS = (*VEHICLE_MONTH, *ATTRIBUTES, "event_timestamp", "trip_distance_km", "trip_fuel_consumed_liters",
          "trip_max_speed_kmh", "trip_duration_minutes", "fuel_efficiency_l_per_100km")


def usable(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Keys and measures present, measures not negative."""
    present = F.lit(True)
    for name in (*keys, *measures):
        present = present & F.col(name).isNotNull()
    for name in measures:
        present = present & (F.col(name) >= 0)
    return df.filter(present)


def totals(df: DataFrame, keys: Sequence[str], sums: dict[str, str | Column]) -> DataFrame:
    """Plain grouped sums: output name -> input column."""
    return df.groupBy(*keys).agg(
        *(F.sum(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in sums.items())
    )


def _merge(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [getattr(F, how)(name).alias(name) for name, (how, _) in PARTIALS.items()]


def partials(silver: DataFrame, keys: Sequence[str] = VEHICLE_MONTH, seen: str = "event_timestamp") -> DataFrame:
    """Mergeable monthly partials of a batch of flat telemetry.

    The description (manufacturer, model) is first a grouping key, so the pass over
    the raw rows is a hash aggregation on fixed-width buffers; only the already
    reduced rows go through the sort that picking the latest description needs.
    """
    clean = usable(silver, keys, ["trip_distance_km", "trip_fuel_consumed_liters"])
    described = clean.groupBy(*keys, *ATTRIBUTES).agg(
        *(getattr(F, how)(F.expr(source)).alias(name) for name, (how, source) in PARTIALS.items()),
        F.max(seen).alias(_SEEN),
    )
    return merge(described, keys=keys)


def merge(*frames: DataFrame, keys: Sequence[str] = VEHICLE_MONTH) -> DataFrame:
    """Combine any number of partial tables into one."""
    combined = by_name(*frames)
    newest = F.max(F.struct(_SEEN, *ATTRIBUTES))
    merged = combined.groupBy(*keys).agg(*_merge(combined, keys), newest.alias("_newest"))
    return merged.select(*keys, *PARTIALS, "_newest.*")


def finish(merged: DataFrame, last_updated: Column | None = None,
           keys: Sequence[str] = VEHICLE_MONTH) -> DataFrame:
    """Partials -> the published monthly table."""
    return merged.select(
        *keys,
        *ATTRIBUTES,
        "total_mileage",
        "total_fuel",
        km_per_litre(F.col("total_mileage"), F.col("total_fuel"), digits=None).alias("km_per_liter"),
        "trip_count",
        F.try_divide("speed_sum", "speed_rows").alias("avg_speed"),
        "max_speed",
        F.try_divide("duration_sum", "duration_rows").alias("avg_trip_duration_minutes"),
        F.try_divide("l_per_100km_sum", "l_per_100km_rows").alias("avg_fuel_efficiency_l_per_100km"),
        F.date_format(F.current_timestamp() if last_updated is None else last_updated,
                      "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
    )


def roll_up(merged: DataFrame, by: Sequence[str] = ("manufacturer", "model")) -> DataFrame:
    """Totals over coarser keys, from partials rather than from averages."""
    grouped = merged.groupBy(*by).agg(*_merge(merged, by))
    return grouped.select(
        *by,
        F.col("trip_count").alias("total_trips"),
        F.col("total_mileage").alias("total_distance_km"),
        F.col("total_fuel").alias("total_fuel_liters"),
        km_per_litre(F.col("total_mileage"), F.col("total_fuel"), digits=None).alias("km_per_liter"),
        F.try_divide("l_per_100km_sum", "l_per_100km_rows").alias("avg_fuel_efficiency_l_per_100km"),
    )
