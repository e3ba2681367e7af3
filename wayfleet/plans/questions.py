"""Ad-hoc questions users ask of the three layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.functions import insurance, ratios, status
from wayfleet.functions.clock import AsOf, hours_between, on_day, today
from wayfleet.functions.parsing import iso_date, iso_timestamp
from wayfleet.operators.ranking import top_k
from wayfleet.operators.summary import distribution



# --- flat telemetry -------------------------------------------------------------------

def least_efficient(silver: DataFrame, k: int = 10) -> DataFrame:
    """Vehicles with the lowest mean km per litre."""
    per_trip = ratios.km_per_litre(F.col("trip_distance_km"), F.col("trip_fuel_consumed_liters"))
    level = ratios.fill_level(F.col("fuel_available_liters"), F.col("fuel_capacity_liters"))
    means = (
        silver.select("car_chassis", "manufacturer", "model", per_trip.alias("kml"), level.alias("level"))
        .filter("kml IS NOT NULL")
        .groupBy("car_chassis", "manufacturer", "model")
        .agg(F.avg("kml").alias("avg_km_per_liter"), F.avg("level").alias("avg_fuel_level_pct"))
    )
    return top_k(means, [F.col("avg_km_per_liter").asc(), F.col("car_chassis").asc()], k)


def daily_speed(silver: DataFrame, year: str, month: str, from_day: str = "01") -> DataFrame:
    """Readings and mean / maximum speed per day of a month."""
    window = on_day(year, month) & (F.col("event_day") >= from_day)
    return (
        silver.filter(window)
        .groupBy("event_year", "event_month", "event_day")
        .agg(
            F.avg("trip_max_speed_kmh").alias("avg_speed"),
            F.max("trip_max_speed_kmh").alias("max_speed"),
            F.count("*").alias("num_readings"),
        )
        .orderBy("event_year", "event_month", "event_day")
    )


def manufacturer_statistics(silver: DataFrame) -> DataFrame:
    per_trip = ratios.km_per_litre(F.col("trip_distance_km"), F.col("trip_fuel_consumed_liters"))
    return (
        silver.groupBy("manufacturer")
        .agg(
            F.countDistinct("car_chassis").alias("num_cars"),
            F.avg("engine_temp_celsius").alias("avg_temp"),
            F.avg(per_trip).alias("avg_efficiency"),
        )
        .orderBy(F.col("num_cars").desc(), "manufacturer")
    )


def expiring_insurance(silver: DataFrame, as_of: AsOf = None, within: int = 90) -> DataFrame:
    """Policies that end at most ``within`` days from now, expired ones included."""
    until, now = iso_date(F.col("insurance_valid_until")), today(as_of)
    return (
        silver.select(
            "event_id", "car_chassis", "manufacturer", "model", "insurance_provider", "insurance_valid_until",
            insurance.days_left(until, now).alias("days_until_expiry"),
        )
        .filter(until <= F.date_add(now, within))
        .orderBy("days_until_expiry", "event_id")
    )


def low_fuel(silver: DataFrame, percent: float = 20) -> DataFrame:
    level = ratios.fill_level(F.col("fuel_available_liters"), F.col("fuel_capacity_liters"))
    return (
        silver.select(
            "event_id", "car_chassis", "manufacturer", "model",
            F.col("fuel_available_liters").alias("fuel_available"),
            F.col("fuel_capacity_liters").alias("tank_capacity"),
            level.alias("fuel_percentage"),
            status.below(level, status.FUEL_PERCENT_BELOW).alias("fuel_status"),
        )
        .filter(F.col("fuel_percentage") < percent)
        .orderBy("fuel_percentage", "event_id")
    )


def speed_trend(silver: DataFrame, year: str, month: str | None = None) -> DataFrame:
    """Mean and standard deviation of speed per date."""
    return (
        silver.filter(on_day(year, month))
        .groupBy(F.to_date("event_timestamp").alias("event_date"))
        .agg(
            F.avg("trip_max_speed_kmh").alias("avg_speed"),
            F.stddev_samp("trip_max_speed_kmh").alias("speed_std_dev"),
            F.count("*").alias("num_readings"),
        )
        .orderBy("event_date")
    )


# --- nested records -------------------------------------------------------------------

_SNAPSHOT = "trip_data.vehicle_telemetry_snapshot.data"
_STATIC = "vehicle_static_info.data"


def nested_fields(bronze: DataFrame) -> DataFrame:
    """A few fields picked out of the nested record by dot notation."""
    return bronze.select(
        "event_id", "carChassis", f"{_STATIC}.Manufacturer", f"{_SNAPSHOT}.engineTempCelsius",
        f"{_SNAPSHOT}.currentMileage", "vehicle_dynamic_state.insurance_info.data.policy_number",
        F.col(f"{_SNAPSHOT}.tire_pressures_psi.front_left").alias("front_left"),
    )


def hot_engines(bronze: DataFrame, above: float = 90) -> DataFrame:
    """Filter on a nested field; the predicate reaches the Parquet reader."""
    return (
        bronze.filter(F.col(f"{_SNAPSHOT}.engineTempCelsius") > above)
        .select("event_id", "carChassis", f"{_STATIC}.Manufacturer", f"{_SNAPSHOT}.engineTempCelsius")
        .orderBy(F.col("engineTempCelsius").desc(), "event_id")
    )


def engine_by_manufacturer(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy(F.col(f"{_STATIC}.Manufacturer").alias("manufacturer"))
        .agg(
            F.count("*").alias("total_records"),
            F.avg(f"{_SNAPSHOT}.engineTempCelsius").alias("avg_engine_temp"),
            F.avg("trip_data.trip_summary.data.tripMaxSpeedKm").alias("avg_speed"),
        )
        .orderBy(F.col("avg_engine_temp").desc(), "manufacturer")
    )


def most_recent_readings(bronze: DataFrame, now: Column, k: int = 20) -> DataFrame:
    """The newest readings and how many hours ago they were taken."""
    taken = iso_timestamp(F.col("event_primary_timestamp"))
    readings = bronze.select(
        "event_id", "carChassis", taken.alias("metric_time"), f"{_SNAPSHOT}.engineTempCelsius",
        hours_between(taken, now).alias("hours_ago"),
    )
    return top_k(readings, [F.col("metric_time").desc_nulls_last(), F.col("event_id").asc()], k)


# --- snapshots and monthly table ------------------------------------------------------

def expired_vehicles(state: DataFrame) -> DataFrame:
    return (
        state.filter(F.col("insurance_status") == insurance.EXPIRED)
        .select("car_chassis", "manufacturer", "model", "insurance_valid_until", "insurance_days_expired")
        .orderBy(F.col("insurance_days_expired").desc_nulls_last(), "car_chassis")
    )


def vehicles_by(state: DataFrame, column: str) -> DataFrame:
    return distribution(state, [column], "total_vehicles").orderBy(F.col("total_vehicles").desc(), column)


def efficiency_by_manufacturer(fuel: DataFrame, year: str) -> DataFrame:
    return (
        fuel.filter(on_day(year))
        .groupBy("manufacturer")
        .agg(F.avg("km_per_liter").alias("avg_efficiency"))
        .orderBy(F.col("avg_efficiency").desc_nulls_last(), "manufacturer")
    )


def low_battery(state: DataFrame, percent: float = 20) -> DataFrame:
    return state.filter(F.col("battery_charge_percentage") < percent)
