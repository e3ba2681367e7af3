"""Silver -> Gold: current state per vehicle, monthly fuel, alert log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.functions import alerts, insurance, ratios, status
from wayfleet.functions.clock import AsOf, today
from wayfleet.functions.parsing import iso_date
from wayfleet.operators import monthly
from wayfleet.operators.latest import latest_per_key
from wayfleet.operators.stamp import stamp
from wayfleet.operators.summary import with_group_count
from wayfleet.operators.upsert import upsert_latest
from wayfleet.plans.silver import STATE_RECENCY

# Columns the curated snapshot takes over unchanged.
CURATED_COLUMNS = (
    "car_chassis", "processing_timestamp",
    "manufacturer", "model", "year", "model_year", "fuel_type", "fuel_capacity_liters", "color",
    "current_mileage_km", "fuel_available_liters", "engine_temp_celsius", "oil_temp_celsius",
    "battery_charge_percentage", "oil_life_percentage", "oil_status",
    "tire_pressure_front_left_psi", "tire_pressure_front_right_psi",
    "tire_pressure_rear_left_psi", "tire_pressure_rear_right_psi",
    "insurance_provider", "insurance_policy_number", "insurance_valid_until",
    "insurance_status", "insurance_days_expired",
    "last_service_date", "last_service_mileage",
    "rental_agreement_id", "rental_customer_id", "rental_start_date",
    "trip_start_timestamp", "trip_end_timestamp", "trip_distance_km", "trip_duration_minutes",
    "trip_fuel_consumed_liters", "trip_max_speed_kmh",
    "fuel_efficiency_l_per_100km", "average_speed_calculated_kmh",
)
ALERT_COLUMNS = (
    "car_chassis", "event_timestamp", "alert_type", "alert_value", "event_year", "event_month", "event_day",
)


def latest_state(silver: DataFrame, keys: Sequence[str] = ("car_chassis",),
                 order: Sequence[str] = STATE_RECENCY) -> DataFrame:
    """One row per vehicle: furthest mileage, then newest event."""
    return latest_per_key(silver, keys, order)


def reclassify_insurance(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Replace the two-valued Silver status by the three-valued one."""
    until, now = iso_date(F.col("insurance_valid_until")), today(as_of)
    return df.withColumns(
        {
            "insurance_status": insurance.three_way_status(until, now),
            "insurance_days_expired": insurance.overdue_days(until, now),
        }
    )


def current_state(silver: DataFrame, as_of: AsOf = None, at: Column | None = None) -> DataFrame:
    """The snapshot table: every Silver column plus two processing columns (57)."""
    state = reclassify_insurance(latest_state(silver), as_of)
    return stamp(state, timestamp="gold_processing_timestamp", date="gold_snapshot_date", at=at)


def merge_current_state(batch: DataFrame, stored: DataFrame, as_of: AsOf = None,
                        at: Column | None = None) -> DataFrame:
    """Snapshot after a batch, from the previous snapshot instead of all of Silver."""
    state = upsert_latest(
        latest_state(batch),
        stored.drop("gold_processing_timestamp", "gold_snapshot_date"),
        ["car_chassis"],
        STATE_RECENCY,
    )
    state = reclassify_insurance(state, as_of)
    return stamp(state, timestamp="gold_processing_timestamp", date="gold_snapshot_date", at=at)


def curated_state(silver: DataFrame, at: Column | None = None) -> DataFrame:
    """The latest state with fuel, service, battery, engine and tire indicators."""
    state = latest_state(silver)
    fuel, tank = F.col("fuel_available_liters"), F.col("fuel_capacity_liters")
    fill = ratios.fill_ratio(fuel, tank)
    since_service = F.col("current_mileage_km") - F.col("last_service_mileage")
    battery, oil = F.col("battery_charge_percentage"), F.col("oil_life_percentage")
    indicators = {
        "fuel_level_percentage": ratios.fill_level(fuel, tank, digits=1),
        "fuel_status": status.below(fill, status.FUEL_RATIO_BELOW),
        "maintenance_status": status.above(since_service, status.SERVICE_KM_ABOVE),
        "km_since_last_service": since_service,
        "battery_status": status.below(battery, status.BATTERY_BELOW),
        "engine_temp_status": status.above(F.col("engine_temp_celsius"), status.ENGINE_TEMP_ABOVE, "NORMAL"),
        "avg_tire_pressure_psi": ratios.mean_of([F.col(c) for c in CURATED_COLUMNS if c.startswith("tire_")]),
        "vehicle_overall_status": status.attention(
            F.col("insurance_status") == insurance.EXPIRED, fill < 0.15, oil < 20, battery < 20
        ),
    }
    named = state.select(
        F.col("event_id").alias("latest_event_id"),
        F.col("event_timestamp").alias("last_update_timestamp"),
        *CURATED_COLUMNS,
        *(c.alias(name) for name, c in indicators.items()),
    )
    return stamp(named, timestamp="gold_processing_timestamp", at=at)


def risk_state(state: DataFrame, at: Column | None = None, version: str = "v2.0_json_complex") -> DataFrame:
    """A snapshot with risk category, fleet size and version tag."""
    rated = state.withColumn("insurance_risk_category", insurance.risk_category(F.col("insurance_status")))
    tagged = stamp(rated, timestamp="data_processing_timestamp", constants={"gold_layer_version": version}, at=at)
    return with_group_count(tagged, "total_vehicles_in_fleet")


def fuel_monthly(silver: DataFrame, last_updated: Column | None = None) -> DataFrame:
    """Monthly fuel efficiency in one pass over Silver."""
    return monthly.finish(monthly.partials(silver), last_updated)


def alert_log(silver: DataFrame, rules: Sequence[alerts.Rule] = alerts.SLIM_RULES) -> DataFrame:
    """The slim alert log: one alert per offending row, seven columns."""
    return alerts.one_alert_per_row(silver, rules).select(*ALERT_COLUMNS)


def full_alert_log(silver: DataFrame, rules: Sequence[alerts.Rule] = alerts.SCENARIO_RULES) -> DataFrame:
    """Every broken rule, one row each, with its severity."""
    return alerts.every_alert(silver, rules).select("event_id", *ALERT_COLUMNS, "alert_status")
