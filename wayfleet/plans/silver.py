"""Bronze -> Silver: flat, typed, one row per event, enriched, dated."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.functions import insurance, ratios, status
from wayfleet.functions.clock import AsOf, date_parts, event_time_or, today
from wayfleet.functions.parsing import LEGACY_NUMERIC, iso_date, iso_timestamp, numeric, weekday_timestamp
from wayfleet.functions.text import tidy
from wayfleet.operators.flatten import EVENT_PATHS, flatten_all, pick
from wayfleet.operators.latest import latest_per_key
from wayfleet.operators.stamp import stamp

# Newest first; later entries only matter when the earlier ones tie.
EVENT_RECENCY = ("event_timestamp", "processing_timestamp")
STATE_RECENCY = ("current_mileage_km", "event_timestamp", "processing_timestamp", "event_id")


def flatten_events(bronze: DataFrame, more: Mapping[str, str] | None = None) -> DataFrame:
    """The 47 flat columns, event time parsed; ``more``: further columns by their path."""
    flat = pick(bronze, {**EVENT_PATHS, **(more or {})})
    return flat.withColumn("event_timestamp", iso_timestamp(F.col("event_timestamp")))


def one_row_per_event(flat: DataFrame) -> DataFrame:
    return latest_per_key(flat, ["event_id"], EVENT_RECENCY)


def enrich(flat: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Add the eight derived Silver columns."""
    until, now = iso_date(F.col("insurance_valid_until")), today(as_of)
    km, fuel = F.col("trip_distance_km"), F.col("trip_fuel_consumed_liters")
    derived = {
        "insurance_status": insurance.two_way_status(until, now),
        "insurance_days_expired": insurance.overdue_days(until, now, otherwise=0),
        "fuel_efficiency_l_per_100km": ratios.litres_per_100km(fuel, km),
        "average_speed_calculated_kmh": ratios.average_speed(km, F.col("trip_duration_minutes")),
        "oil_status": status.below(F.col("oil_life_percentage"), status.OIL_BELOW),
        **date_parts(F.col("event_timestamp"), "event"),
    }
    return flat.withColumns(derived)


def silver(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Flat Silver rows of a Bronze frame (55 columns)."""
    return enrich(one_row_per_event(flatten_events(bronze)), as_of)


def event_days(bronze: DataFrame) -> DataFrame:
    """Id and day of every row of ``silver``: the latest copy has the latest time, so no other column is needed."""
    times = flatten_events(bronze).groupBy("event_id").agg(F.max("event_timestamp").alias("event_timestamp"))
    return times.select("event_id", *(c.alias(name) for name, c in date_parts(F.col("event_timestamp"), "event").items()))


def dated(df: DataFrame) -> DataFrame:
    """Rows that belong in an event-date partition."""
    return df.filter(F.col("event_year").isNotNull())


def undated(df: DataFrame) -> DataFrame:
    """Rows without a usable event time; kept aside instead of in a default partition."""
    return df.filter(F.col("event_year").isNull())


def legacy_silver(bronze: DataFrame, as_of: AsOf = None, *, iso_times: bool = False,
                  empty_efficiency: float | None = 0.0, at: Column | None = None) -> DataFrame:
    """First-generation records, flattened under their nested names and enriched.

    ``iso_times``: metric times are ISO strings rather than weekday-prefixed ones.
    ``empty_efficiency``: km per litre where no fuel was used (0.0, or None for NULL).
    """
    flat = tidy(flatten_all(bronze), title=["Manufacturer", "carInsurance_provider"], lower=["color"], trim=True)
    parse = iso_timestamp if iso_times else weekday_timestamp
    typed = numeric(flat, LEGACY_NUMERIC).withColumns(
        {
            "metrics_metricTimestamp": parse(F.col("metrics_metricTimestamp")),
            "metrics_trip_tripStartTimestamp": parse(F.col("metrics_trip_tripStartTimestamp")),
            "carInsurance_validUntil": iso_date(F.col("carInsurance_validUntil")),
        }
    )
    until, now = F.col("carInsurance_validUntil"), today(as_of)
    kpis = typed.withColumns(
        {
            "metrics_fuel_level_percentage": ratios.fill_level(
                F.col("metrics_fuelAvailableLiters"), F.col("fuelCapacityLiters")
            ),
            "metrics_trip_km_per_liter": ratios.km_per_litre(
                F.col("metrics_trip_tripMileage"), F.col("metrics_trip_tripFuelLiters"), empty=empty_efficiency
            ),
            "insurance_days_to_expiry": insurance.days_left(until, now),
            "insurance_status": insurance.three_way_status(until, now),
            "insurance_days_expired": insurance.overdue_days(until, now, otherwise=0),
        }
    )
    event_time = event_time_or(kpis, "metrics_metricTimestamp", F.current_timestamp())
    stamped = stamp(kpis, timestamp="silver_processing_timestamp", date="silver_processing_date", at=at)
    return stamped.withColumns(date_parts(event_time, "event"))
