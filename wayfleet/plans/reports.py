"""The standing reports. Each is a lazy frame, ordered the way it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfleet.functions import insurance
from wayfleet.functions.clock import AsOf, in_current_month, in_recent_years
from wayfleet.operators.ranking import top_k, top_ranks
from wayfleet.operators.sections import custom_order, section, stack
from wayfleet.operators.summary import pct_in_range, pct_of_rows, with_share

_STATUS_ORDER = (insurance.EXPIRED, insurance.EXPIRING, insurance.ACTIVE)

_INSURANCE_LAYOUT = {
    "insurance_status": "string", "vehicle_count": "bigint", "percentage": "double",
    "avg_days_expired": "double", "max_days_expired": "int",
    "car_chassis": "string", "manufacturer": "string", "model": "string", "provider": "string",
}
_ALERT_LAYOUT = {
    "alert_type": "string", "alert_count": "bigint", "affected_vehicles": "bigint",
    "avg_value": "double", "max_value": "double",
    "car_chassis": "string", "frequency": "bigint", "last_alert": "timestamp",
}
_FUEL_LAYOUT = {
    "event_year": "string", "event_month": "string", "manufacturer": "string", "vehicle_count": "bigint",
    "efficiency_kml": "double", "fuel_consumption": "double", "mileage": "double",
    "car_chassis": "string", "model": "string", "efficiency_rank": "int",
}


def _cols(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def insurance_distribution(state: DataFrame) -> DataFrame:
    """Vehicles per insurance status with share and days-expired figures."""
    expired_days = F.when(F.col("insurance_status") == insurance.EXPIRED, F.col("insurance_days_expired"))
    counted = state.filter(F.col("insurance_status").isNotNull()).groupBy("insurance_status").agg(
        F.count("*").alias("vehicle_count"),
        F.avg(expired_days).alias("avg_days_expired"),
        F.max(expired_days).alias("max_days_expired"),
    )
    shared = with_share(counted, "vehicle_count", "percentage")
    return shared.orderBy(custom_order(F.col("insurance_status"), _STATUS_ORDER))


def insurance_report(state: DataFrame, overdue: int = 30, k: int = 10) -> DataFrame:
    """Status summary, then the ``k`` vehicles longest without cover."""
    summary = insurance_distribution(state).fillna(0, ["avg_days_expired", "max_days_expired"])
    uncovered = state.filter(
        (F.col("insurance_status") == insurance.EXPIRED) & (F.col("insurance_days_expired") > overdue)
    )
    critical = top_k(uncovered, [F.col("insurance_days_expired").desc(), F.col("car_chassis").asc()], k)
    parts = [
        section(summary, "SUMMARY", _INSURANCE_LAYOUT,
                _cols("insurance_status", "vehicle_count", "percentage", "avg_days_expired", "max_days_expired")),
        section(critical, "CRITICAL_VEHICLES", _INSURANCE_LAYOUT, {
            **_cols("insurance_status", "car_chassis", "manufacturer", "model"),
            "avg_days_expired": F.col("insurance_days_expired"),
            "provider": F.col("insurance_provider"),
        }),
    ]
    in_summary = F.when(F.col("report_section") == "SUMMARY", F.col("insurance_status"))
    return stack(parts).orderBy(
        F.col("report_section").desc(), in_summary.asc_nulls_last(), F.col("avg_days_expired").desc_nulls_last(),
        "car_chassis",
    )


def state_overview(state: DataFrame) -> DataFrame:
    """Every vehicle, worst insurance first."""
    shown = state.select(
        "car_chassis", "manufacturer", "model", "year", "color", "current_mileage_km",
        "insurance_status", "insurance_days_expired", "insurance_provider", "insurance_valid_until",
        "engine_temp_celsius", "battery_charge_percentage", "fuel_available_liters",
        "gold_processing_timestamp", "gold_snapshot_date",
    )
    return shown.orderBy(
        custom_order(F.col("insurance_status"), _STATUS_ORDER),
        F.col("insurance_days_expired").desc_nulls_last(),
        "car_chassis",
    )


def alert_report(log: DataFrame, as_of: AsOf = None, at_least: int = 3, k: int = 20) -> DataFrame:
    """This month's alerts by type, then the vehicles that repeat them most.

    Both sections start from the same per (vehicle, type) aggregate, so vehicles
    are counted without a distinct and averages come from sums and counts.
    """
    per_vehicle = log.filter(in_current_month(as_of)).groupBy("car_chassis", "alert_type").agg(
        F.count("*").alias("frequency"),
        F.sum("alert_value").alias("value_sum"),
        F.count("alert_value").alias("value_rows"),
        F.max("alert_value").alias("value_max"),
        F.max("event_timestamp").alias("last_alert"),
    )
    average = F.round(F.try_divide("value_sum", "value_rows"), 2)
    by_type = per_vehicle.groupBy("alert_type").agg(
        F.sum("frequency").alias("alert_count"),
        F.count("car_chassis").alias("affected_vehicles"),
        F.round(F.try_divide(F.sum("value_sum"), F.sum("value_rows")), 2).alias("avg_value"),
        F.max("value_max").alias("max_value"),
    )
    repeating = per_vehicle.filter(F.col("frequency") >= at_least).withColumn("avg_value", average)
    worst = top_k(
        repeating,
        [F.col("frequency").desc(), F.try_divide("value_sum", "value_rows").desc(), F.col("car_chassis").asc(),
         F.col("alert_type").asc()],
        k,
    )
    parts = [
        section(by_type, "ALERT_SUMMARY", _ALERT_LAYOUT,
                _cols("alert_type", "alert_count", "affected_vehicles", "avg_value", "max_value")),
        section(worst, "PROBLEM_VEHICLES", _ALERT_LAYOUT,
                _cols("alert_type", "avg_value", "car_chassis", "frequency", "last_alert")),
    ]
    return stack(parts).orderBy(
        F.col("report_section").desc(), "alert_type", F.col("frequency").desc_nulls_last(), "car_chassis"
    )


def fuel_report(fuel: DataFrame, as_of: AsOf = None, min_months: int = 3, ranks: int = 10) -> DataFrame:
    """Two years of monthly trends by manufacturer, then the most efficient vehicles."""
    trends = fuel.filter(in_recent_years(as_of, 2)).groupBy(*_cols("event_year", "event_month", "manufacturer")).agg(
        # One row per vehicle and month, so rows are vehicles.
        F.count("car_chassis").alias("vehicle_count"),
        F.round(F.avg("km_per_liter"), 2).alias("efficiency_kml"),
        F.round(F.avg("total_fuel"), 2).alias("fuel_consumption"),
        F.round(F.avg("total_mileage"), 2).alias("mileage"),
    )
    tracked = fuel.filter(in_recent_years(as_of, 1)).groupBy("car_chassis", "manufacturer", "model").agg(
        F.avg("km_per_liter").alias("avg_efficiency"),
        F.round(F.avg("total_fuel"), 2).alias("fuel_consumption"),
        F.count("*").alias("vehicle_count"),
    ).filter(F.col("vehicle_count") >= min_months)
    efficient = top_ranks(tracked, "avg_efficiency", ranks, "efficiency_rank")
    parts = [
        section(trends, "MONTHLY_TRENDS", _FUEL_LAYOUT,
                _cols("event_year", "event_month", "manufacturer", "vehicle_count", "efficiency_kml",
                      "fuel_consumption", "mileage")),
        section(efficient, "TOP_EFFICIENT", _FUEL_LAYOUT, {
            **_cols("manufacturer", "vehicle_count", "fuel_consumption", "car_chassis", "model", "efficiency_rank"),
            "efficiency_kml": F.round("avg_efficiency", 2),
        }),
    ]
    return stack(parts).orderBy(
        F.col("report_section").desc(), F.col("event_year").desc_nulls_last(), F.col("event_month").desc_nulls_last(),
        F.col("efficiency_rank").asc_nulls_last(), F.col("efficiency_kml").desc_nulls_last(), "manufacturer",
        "car_chassis",
    )


def _missing(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def quality_monitor(silver: DataFrame, state: DataFrame, log: DataFrame, as_of: AsOf = None,
                    at: Column | None = None) -> DataFrame:
    """Row counts, gaps and two health percentages for each of the three layers."""
    this_month = in_current_month(as_of)
    layers = {
        "SILVER": (silver.filter(this_month), _missing("event_timestamp"), _missing("insurance_valid_until"),
                   pct_in_range("engine_temp_celsius", 0, 150), pct_in_range("fuel_available_liters", 0, 200)),
        "GOLD_CURRENT_STATE": (state, _missing("insurance_status"), _missing("insurance_valid_until"),
                               pct_of_rows(F.col("insurance_status") == insurance.EXPIRED),
                               pct_of_rows(F.col("insurance_status") == insurance.ACTIVE)),
        "PERFORMANCE_ALERTS": (log.filter(this_month), _missing("alert_type"), F.lit(0).cast("bigint"),
                               pct_of_rows(F.col("alert_type") == "OVERHEAT_ENGINE"),
                               pct_of_rows(F.col("alert_type") == "SPEEDING_ALERT")),
    }
    rows = []
    for name, (df, key_gaps, insurance_gaps, first, second) in layers.items():
        figures = df.agg(
            F.count("*").alias("total_records"),
            F.countDistinct("car_chassis").alias("unique_vehicles"),
            key_gaps.alias("missing_key_field"),
            insurance_gaps.alias("missing_insurance"),
            F.round(first, 2).alias("quality_metric_1"),
            F.round(second, 2).alias("quality_metric_2"),
        )
        rows.append(figures.select(F.lit(name).alias("layer"), "*"))
    checked = F.current_timestamp() if at is None else at
    return stack(rows).withColumn("quality_check_time", checked).orderBy("layer")
