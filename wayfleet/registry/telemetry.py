"""Queries that run the telemetry plans over events derived from lineitem."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wayfleet.functions import alerts
from wayfleet.functions.clock import in_recent_years
from wayfleet.operators import flatten, monthly
from wayfleet.operators.latest import content_hash, duplicate_keys, reduction_stats
from wayfleet.operators.quality import Checks, quality_report, row_score
from wayfleet.operators.reconcile import beside_survivor, reconcile, reconcile_summary
from wayfleet.operators.summary import distribution, overall, violation_rate
from wayfleet.plans import gold, questions, reports
from wayfleet.plans.silver import EVENT_RECENCY, dated, flatten_events, silver, undated
from wayfleet.registry.base import query, rounded, settled
from wayfleet.registry.fleet import ALERTS, FLAT, FUEL, SILVER, STATE, events
from wayfleet.session import scratch

AS_OF = dt.date(1998, 9, 2)


def moment():
    return F.lit("1998-09-02 06:00:00").cast("timestamp")


def settle(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Zone-free timestamps, and doubles rounded where summation order shows."""
    changes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            changes[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif digits is not None and isinstance(f.dataType, T.DoubleType):
            changes[f.name] = F.round(f.name, digits)
    return df.withColumns(changes) if changes else df


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return silver(events(spark, d), AS_OF)


def _state(spark: SparkSession, d: str) -> DataFrame:
    return gold.current_state(_silver(spark, d), AS_OF, moment())


def _fuel(spark: SparkSession, d: str) -> DataFrame:
    return gold.fuel_monthly(dated(_silver(spark, d)))


# --- Silver ---------------------------------------------------------------------------

@query("fleet_flatten", f"WITH {FLAT} SELECT * FROM flat")
def fleet_flatten(spark, d):
    return settle(flatten_events(events(spark, d)))


@query("fleet_silver", f"WITH {SILVER} SELECT * FROM silver")
def fleet_silver(spark, d):
    return settle(_silver(spark, d))


@query("fleet_undated", f"WITH {SILVER} SELECT event_id, car_chassis, processing_timestamp FROM silver WHERE event_year IS NULL")
def fleet_undated(spark, d):
    return undated(_silver(spark, d)).select("event_id", "car_chassis", "processing_timestamp")


@query("fleet_reduction_stats", f"""WITH {FLAT} SELECT count(*) AS total_rows, count(DISTINCT event_id) AS distinct_keys,
    count(*) - count(DISTINCT event_id) AS removed_rows,
    {rounded('(count(*) - count(DISTINCT event_id)) * 1e2 / count(*)', 1)} AS reduction_pct FROM flat""")
def fleet_reduction_stats(spark, d):
    return reduction_stats(flatten_events(events(spark, d)), ["event_id"])


@query("fleet_redelivered", f"WITH {FLAT} SELECT event_id, count(*) AS copies FROM flat GROUP BY event_id HAVING count(*) > 1")
def fleet_redelivered(spark, d):
    return duplicate_keys(flatten_events(events(spark, d)), ["event_id"])


@query("nested_numbers_widened", f"""WITH {FLAT} SELECT event_id,
    CAST(year AS DOUBLE) AS vehicle_static_info_data_year,
    CAST(fuel_capacity_liters AS DOUBLE) AS vehicle_static_info_data_fuel_capacity_liters,
    trip_distance_km AS trip_data_trip_summary_data_trip_mileage,
    CAST(trip_duration_minutes AS DOUBLE) AS trip_data_trip_summary_data_trip_time_minutes,
    CAST(current_mileage_km AS DOUBLE) AS trip_data_vehicle_telemetry_snapshot_data_current_mileage FROM flat""")
def nested_numbers_widened(spark, d):
    flat = flatten.snake_columns(flatten.flatten_all(flatten.widen_nested_numbers(events(spark, d))))
    return flat.select(
        "event_id", "vehicle_static_info_data_year", "vehicle_static_info_data_fuel_capacity_liters",
        "trip_data_trip_summary_data_trip_mileage", "trip_data_trip_summary_data_trip_time_minutes",
        "trip_data_vehicle_telemetry_snapshot_data_current_mileage",
    )


# --- products -------------------------------------------------------------------------

@query("fleet_current_state", f"WITH {STATE} SELECT * FROM state")
def fleet_current_state(spark, d):
    return settle(_state(spark, d))


_FILL = "fuel_available_liters / nullif(fuel_capacity_liters, 0)"


@query("fleet_curated_state", f"""WITH {STATE} SELECT event_id AS latest_event_id, event_timestamp AS last_update_timestamp,
    {', '.join(gold.CURATED_COLUMNS)},
    {rounded(_FILL + ' * 100', 1)} AS fuel_level_percentage,
    CASE WHEN {_FILL} < 0.15e0 THEN 'CRITICAL' WHEN {_FILL} < 0.30e0 THEN 'LOW' ELSE 'OK' END AS fuel_status,
    CASE WHEN current_mileage_km - last_service_mileage > 10000 THEN 'OVERDUE'
         WHEN current_mileage_km - last_service_mileage > 8000 THEN 'DUE_SOON' ELSE 'OK' END AS maintenance_status,
    current_mileage_km - last_service_mileage AS km_since_last_service,
    CASE WHEN battery_charge_percentage < 20 THEN 'CRITICAL' WHEN battery_charge_percentage < 40 THEN 'LOW'
         ELSE 'OK' END AS battery_status,
    CASE WHEN engine_temp_celsius > 100 THEN 'OVERHEATING' WHEN engine_temp_celsius > 95 THEN 'HIGH'
         ELSE 'NORMAL' END AS engine_temp_status,
    {rounded('(tire_pressure_front_left_psi + tire_pressure_front_right_psi + tire_pressure_rear_left_psi + tire_pressure_rear_right_psi) / 4', 1)} AS avg_tire_pressure_psi,
    CASE WHEN insurance_status = 'VENCIDO' OR {_FILL} < 0.15e0 OR oil_life_percentage < 20
         OR battery_charge_percentage < 20 THEN 'ATTENTION_REQUIRED' ELSE 'OPERATIONAL' END AS vehicle_overall_status,
    TIMESTAMP '1998-09-02 06:00:00' AS gold_processing_timestamp
    FROM latest""")
def fleet_curated_state(spark, d):
    return settle(gold.curated_state(_silver(spark, d), moment()))


@query("fleet_risk_state", f"""WITH {STATE} SELECT car_chassis, insurance_status,
    CASE insurance_status WHEN 'VENCIDO' THEN 'ALTO_RISCO' WHEN 'VENCENDO_EM_90_DIAS' THEN 'MEDIO_RISCO'
         ELSE 'BAIXO_RISCO' END AS insurance_risk_category,
    'v2.0_json_complex' AS gold_layer_version, (SELECT count(*) FROM state) AS total_vehicles_in_fleet FROM state""")
def fleet_risk_state(spark, d):
    return gold.risk_state(_state(spark, d)).select(
        "car_chassis", "insurance_status", "insurance_risk_category", "gold_layer_version", "total_vehicles_in_fleet"
    )


_FUEL_SQL = f"""WITH {FUEL} SELECT car_chassis, event_year, event_month, manufacturer, model,
    total_mileage, total_fuel, {rounded('km_per_liter', 9)} AS km_per_liter, trip_count,
    {rounded('avg_speed', 9)} AS avg_speed, max_speed,
    {rounded('avg_trip_duration_minutes', 9)} AS avg_trip_duration_minutes,
    {rounded('avg_fuel_efficiency_l_per_100km', 9)} AS avg_fuel_efficiency_l_per_100km FROM fuel"""


@query("fleet_fuel_monthly", _FUEL_SQL)
def fleet_fuel_monthly(spark, d):
    return settle(_fuel(spark, d).drop("last_updated"), 9)


@query("fleet_fuel_merged", _FUEL_SQL)
def fleet_fuel_merged(spark, d):
    """Three batches aggregated apart and merged out of order give the one-pass table."""
    rows = dated(_silver(spark, d))
    lot = F.pmod(F.xxhash64("event_id"), F.lit(3))
    lots = [monthly.partials(rows.filter(lot == i)) for i in (2, 0, 1)]
    return settle(monthly.finish(monthly.merge(*lots)).drop("last_updated"), 9)


@query("fleet_fuel_roll_up", f"""WITH {FUEL} SELECT manufacturer, model, count(*) AS total_trips,
    round(sum(trip_distance_km), 4) AS total_distance_km, round(sum(trip_fuel_consumed_liters), 4) AS total_fuel_liters,
    {rounded('CASE WHEN sum(trip_fuel_consumed_liters) > 0 THEN sum(trip_distance_km) / sum(trip_fuel_consumed_liters) END', 4)} AS km_per_liter,
    {rounded('avg(fuel_efficiency_l_per_100km)', 4)} AS avg_fuel_efficiency_l_per_100km
    FROM trips GROUP BY manufacturer, model""")
def fleet_fuel_roll_up(spark, d):
    return settle(monthly.roll_up(monthly.partials(dated(_silver(spark, d)))), 4)


@query("fleet_fuel_totals", f"""WITH {FUEL} SELECT count(*) AS car_months, round(sum(total_mileage), 3) AS total_km,
    round(sum(total_fuel), 3) AS total_litres, {rounded('avg(km_per_liter)', 4)} AS avg_efficiency FROM fuel""")
def fleet_fuel_totals(spark, d):
    figures = overall(_fuel(spark, d), {
        "car_months": F.count("car_chassis"),
        "total_km": F.round(F.sum("total_mileage"), 3),
        "total_litres": F.round(F.sum("total_fuel"), 3),
        "avg_efficiency": F.round(F.avg("km_per_liter"), 4),
    })
    return figures


@query("fleet_alerts", f"WITH {ALERTS} SELECT * FROM alerts")
def fleet_alerts(spark, d):
    return settle(gold.alert_log(_silver(spark, d)))


@query("fleet_alert_distribution", f"WITH {ALERTS} SELECT alert_type, count(*) AS n FROM alerts GROUP BY alert_type")
def fleet_alert_distribution(spark, d):
    return distribution(gold.alert_log(_silver(spark, d)), ["alert_type"])


_TIRE = ("least(tire_pressure_front_left_psi, tire_pressure_front_right_psi, "
         "tire_pressure_rear_left_psi, tire_pressure_rear_right_psi)")


def _each(rules: list[tuple[str, str, str, str]]) -> str:
    branches = [
        f"SELECT event_id, car_chassis, event_timestamp, '{label}' AS alert_type, CAST({measure} AS DOUBLE) AS alert_value, "
        f"event_year, event_month, event_day, '{severity}' AS alert_status FROM silver WHERE {measure} {test}"
        for label, measure, test, severity in rules
    ]
    return f"WITH {SILVER} " + " UNION ALL ".join(branches)


@query("fleet_alerts_multi", _each([
    ("OVERHEAT_ENGINE", "engine_temp_celsius", "> 100", "HIGH"),
    ("OVERHEAT_OIL", "oil_temp_celsius", "> 115", "HIGH"),
    ("LOW_TIRE_PRESSURE", _TIRE, "< 30", "HIGH"),
    ("LOW_BATTERY", "battery_charge_percentage", "< 70", "HIGH"),
    ("LOW_FUEL", "(fuel_available_liters / nullif(fuel_capacity_liters, 0) * 100)", "< 20", "HIGH"),
]))
def fleet_alerts_multi(spark, d):
    return settle(gold.full_alert_log(_silver(spark, d)))


@query("fleet_alerts_severity", _each([
    ("ALTA_TEMPERATURA_MOTOR", "engine_temp_celsius", "> 100", "HIGH"),
    ("ALTA_TEMPERATURA_OLEO", "oil_temp_celsius", "> 120", "HIGH"),
    ("EXCESSO_VELOCIDADE", "trip_max_speed_kmh", "> 120", "HIGH"),
]))
def fleet_alerts_severity(spark, d):
    return settle(gold.full_alert_log(_silver(spark, d), alerts.SEVERITY_RULES))


@query("fleet_alerts_maintenance", _each([
    ("OIL_CRITICAL", "oil_life_percentage", "< 20", "CRITICAL"),
    ("OIL_LOW", "oil_life_percentage", "BETWEEN 20 AND 49.99e0", "LOW"),
    ("ENGINE_TEMP", "engine_temp_celsius", "> 100", "CRITICAL"),
    ("TIRE_PRESSURE", _TIRE, "< 30", "LOW"),
    ("INSURANCE_EXPIRED", "insurance_days_expired", "> 0", "CRITICAL"),
]))
def fleet_alerts_maintenance(spark, d):
    return settle(gold.full_alert_log(_silver(spark, d), alerts.MAINTENANCE_RULES))


@query("fleet_violation_rate", f"""WITH {ALERTS} SELECT (SELECT count(*) FROM silver) AS total_rows, count(*) AS alert_rows,
    {rounded('count(*) * 1e2 / (SELECT count(*) FROM silver)', 2)} AS violation_rate_pct FROM alerts""")
def fleet_violation_rate(spark, d):
    return violation_rate(_silver(spark, d), alerts.any_fired(alerts.SLIM_RULES))


# --- reports --------------------------------------------------------------------------

_DISTRIBUTION = """SELECT insurance_status, count(*) AS vehicle_count, count(*) * 1e2 / sum(count(*)) OVER () AS share,
    avg(CASE WHEN insurance_status = 'VENCIDO' THEN insurance_days_expired END) AS avg_days,
    max(CASE WHEN insurance_status = 'VENCIDO' THEN insurance_days_expired END) AS max_days
    FROM state WHERE insurance_status IS NOT NULL GROUP BY insurance_status"""


@query("report_insurance_distribution", f"""WITH {STATE} SELECT insurance_status, vehicle_count,
    {rounded('share', 2)} AS percentage, {rounded('avg_days', 4)} AS avg_days_expired, max_days AS max_days_expired
    FROM ({_DISTRIBUTION})""")
def report_insurance_distribution(spark, d):
    return settle(reports.insurance_distribution(_state(spark, d)), 4)


@query("report_insurance", f"""WITH {STATE}, dist AS ({_DISTRIBUTION})
    SELECT 'SUMMARY' AS report_section, insurance_status, vehicle_count, {rounded('share', 2)} AS percentage,
        {rounded('coalesce(avg_days, 0)', 4)} AS avg_days_expired, coalesce(max_days, 0) AS max_days_expired,
        NULL AS car_chassis, NULL AS manufacturer, NULL AS model, NULL AS provider FROM dist
    UNION ALL
    SELECT * FROM (SELECT 'CRITICAL_VEHICLES', insurance_status, NULL, NULL, CAST(insurance_days_expired AS DOUBLE), NULL,
        car_chassis, manufacturer, model, insurance_provider FROM state
    WHERE insurance_status = 'VENCIDO' AND insurance_days_expired > 30
    ORDER BY insurance_days_expired DESC, car_chassis LIMIT 10)""")
def report_insurance(spark, d):
    return settle(reports.insurance_report(_state(spark, d)), 4)


@query("report_state_overview", f"""WITH {STATE} SELECT car_chassis, manufacturer, model, year, color, current_mileage_km,
    insurance_status, insurance_days_expired, insurance_provider, insurance_valid_until, engine_temp_celsius,
    battery_charge_percentage, fuel_available_liters, gold_processing_timestamp, gold_snapshot_date FROM state""")
def report_state_overview(spark, d):
    return settle(reports.state_overview(_state(spark, d)))


@query("report_alerts", f"""WITH {ALERTS}, month AS (SELECT * FROM alerts WHERE event_year = '1998' AND event_month = '09')
    SELECT 'ALERT_SUMMARY' AS report_section, alert_type, count(*) AS alert_count,
        count(DISTINCT car_chassis) AS affected_vehicles, {rounded('avg(alert_value)', 2)} AS avg_value,
        max(alert_value) AS max_value, NULL AS car_chassis, NULL AS frequency, NULL AS last_alert
    FROM month GROUP BY alert_type
    UNION ALL
    SELECT * FROM (SELECT 'PROBLEM_VEHICLES', alert_type, NULL, NULL, {rounded('avg(alert_value)', 2)}, NULL,
        car_chassis, count(*), max(event_timestamp)
    FROM month GROUP BY car_chassis, alert_type HAVING count(*) >= 3
    ORDER BY count(*) DESC, avg(alert_value) DESC, car_chassis, alert_type LIMIT 20)""")
def report_alerts(spark, d):
    return settle(reports.alert_report(gold.alert_log(_silver(spark, d)), AS_OF))


@query("report_fuel", f"""WITH {FUEL},
    exact AS (SELECT * REPLACE (CAST(total_mileage AS DECIMAL(18, 4)) AS total_mileage,
        CAST(total_fuel AS DECIMAL(18, 4)) AS total_fuel, CAST(km_per_liter AS DECIMAL(18, 9)) AS km_per_liter) FROM fuel),
    tracked AS (SELECT car_chassis, manufacturer, model, avg(km_per_liter) AS eff, avg(total_fuel) AS litres, count(*) AS months
        FROM exact WHERE event_year = '1998' GROUP BY car_chassis, manufacturer, model HAVING count(*) >= 3),
    ranked AS (SELECT *, rank() OVER (ORDER BY eff DESC NULLS LAST) AS r FROM tracked)
    SELECT 'MONTHLY_TRENDS' AS report_section, event_year, event_month, manufacturer, count(DISTINCT car_chassis) AS vehicle_count,
        {rounded('avg(km_per_liter)', 2)} AS efficiency_kml, {rounded('avg(total_fuel)', 2)} AS fuel_consumption,
        {rounded('avg(total_mileage)', 2)} AS mileage, NULL AS car_chassis, NULL AS model, NULL AS efficiency_rank
    FROM exact WHERE event_year IN ('1998', '1997') GROUP BY event_year, event_month, manufacturer
    UNION ALL
    SELECT 'TOP_EFFICIENT', NULL, NULL, manufacturer, months, {rounded('eff', 2)}, {rounded('litres', 2)}, NULL,
        car_chassis, model, CAST(r AS INT) FROM ranked WHERE r <= 10""")
def report_fuel(spark, d):
    # Exact decimals, so that averages do not depend on the order of addition.
    exact = {"total_mileage": "decimal(18,4)", "total_fuel": "decimal(18,4)", "km_per_liter": "decimal(18,9)"}
    fuel = _fuel(spark, d).withColumns({c: F.col(c).cast(t) for c, t in exact.items()})
    # Each section starts from these rows; Silver is worked out once.
    recent = fuel.filter(in_recent_years(AS_OF, 2)).drop("last_updated")
    return reports.fuel_report(settled(recent, scratch(spark, "recent-fuel")), AS_OF)


def _pct(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END) * 1e2 / count(*)"


@query("report_quality", f"""WITH {STATE},
    alerts AS (SELECT car_chassis, event_year, event_month,
        CASE WHEN engine_temp_celsius > 100 THEN 'OVERHEAT_ENGINE' WHEN oil_temp_celsius > 110 THEN 'OVERHEAT_OIL'
             ELSE 'SPEEDING_ALERT' END AS alert_type
        FROM silver WHERE engine_temp_celsius > 100 OR oil_temp_celsius > 110 OR trip_max_speed_kmh > 110)
    SELECT 'SILVER' AS layer, count(*) AS total_records, count(DISTINCT car_chassis) AS unique_vehicles,
        count(*) - count(event_timestamp) AS missing_key_field, count(*) - count(insurance_valid_until) AS missing_insurance,
        {rounded('avg(CASE WHEN engine_temp_celsius BETWEEN 0 AND 150 THEN 1e0 ELSE 0e0 END) * 100', 2)} AS quality_metric_1,
        {rounded('avg(CASE WHEN fuel_available_liters BETWEEN 0 AND 200 THEN 1e0 ELSE 0e0 END) * 100', 2)} AS quality_metric_2,
        TIMESTAMP '1998-09-02 06:00:00' AS quality_check_time
    FROM silver WHERE event_year = '1998' AND event_month = '09'
    UNION ALL
    SELECT 'GOLD_CURRENT_STATE', count(*), count(DISTINCT car_chassis), count(*) - count(insurance_status),
        count(*) - count(insurance_valid_until), {rounded(_pct("insurance_status = 'VENCIDO'"), 2)},
        {rounded(_pct("insurance_status = 'ATIVO'"), 2)}, TIMESTAMP '1998-09-02 06:00:00' FROM state
    UNION ALL
    SELECT 'PERFORMANCE_ALERTS', count(*), count(DISTINCT car_chassis), count(*) - count(alert_type), 0,
        {rounded(_pct("alert_type = 'OVERHEAT_ENGINE'"), 2)}, {rounded(_pct("alert_type = 'SPEEDING_ALERT'"), 2)},
        TIMESTAMP '1998-09-02 06:00:00' FROM alerts WHERE event_year = '1998' AND event_month = '09'""")
def report_quality(spark, d):
    flat = _silver(spark, d)
    return settle(
        reports.quality_monitor(flat, gold.current_state(flat, AS_OF), gold.alert_log(flat), AS_OF, moment())
    )


# --- ad-hoc questions -----------------------------------------------------------------

_KML = f"CASE WHEN trip_fuel_consumed_liters > 0 THEN {rounded('trip_distance_km / nullif(trip_fuel_consumed_liters, 0)', 2)} END"
_LEVEL = rounded("fuel_available_liters / nullif(fuel_capacity_liters, 0) * 100", 2)


@query("ask_least_efficient", f"""WITH {SILVER} SELECT car_chassis, manufacturer, model,
    {rounded('avg(kml)', 4)} AS avg_km_per_liter, {rounded('avg(level)', 4)} AS avg_fuel_level_pct
    FROM (SELECT *, {_KML} AS kml, {_LEVEL} AS level FROM silver) WHERE kml IS NOT NULL
    GROUP BY car_chassis, manufacturer, model ORDER BY avg(kml), car_chassis LIMIT 10""")
def ask_least_efficient(spark, d):
    return settle(questions.least_efficient(_silver(spark, d)), 4)


@query("ask_daily_speed", f"""WITH {SILVER} SELECT event_year, event_month, event_day,
    {rounded('avg(trip_max_speed_kmh)', 4)} AS avg_speed, max(trip_max_speed_kmh) AS max_speed, count(*) AS num_readings
    FROM silver WHERE event_year = '1998' AND event_month = '10' AND event_day >= '23'
    GROUP BY event_year, event_month, event_day""")
def ask_daily_speed(spark, d):
    return settle(questions.daily_speed(_silver(spark, d), "1998", "10", "23"), 4)


@query("ask_manufacturers", f"""WITH {SILVER} SELECT manufacturer, count(DISTINCT car_chassis) AS num_cars,
    {rounded('avg(engine_temp_celsius)', 4)} AS avg_temp, {rounded('avg(kml)', 4)} AS avg_efficiency
    FROM (SELECT *, {_KML} AS kml FROM silver) GROUP BY manufacturer""")
def ask_manufacturers(spark, d):
    return settle(questions.manufacturer_statistics(_silver(spark, d)), 4)


@query("ask_expiring_insurance", f"""WITH {SILVER} SELECT event_id, car_chassis, manufacturer, model, insurance_provider,
    insurance_valid_until, CAST(try_cast(insurance_valid_until AS DATE) - DATE '1998-09-02' AS INT) AS days_until_expiry
    FROM silver WHERE try_cast(insurance_valid_until AS DATE) <= DATE '1998-09-02' + INTERVAL 90 DAY""")
def ask_expiring_insurance(spark, d):
    return questions.expiring_insurance(_silver(spark, d), AS_OF)


@query("ask_low_fuel", f"""WITH {SILVER} SELECT event_id, car_chassis, manufacturer, model,
    fuel_available_liters AS fuel_available, fuel_capacity_liters AS tank_capacity, level AS fuel_percentage,
    CASE WHEN level < 10 THEN 'CRÍTICO' WHEN level < 20 THEN 'BAIXO' ELSE 'OK' END AS fuel_status
    FROM (SELECT *, {_LEVEL} AS level FROM silver) WHERE level < 20""")
def ask_low_fuel(spark, d):
    return questions.low_fuel(_silver(spark, d))


@query("ask_speed_trend", f"""WITH {SILVER} SELECT CAST(event_timestamp AS DATE) AS event_date,
    {rounded('avg(trip_max_speed_kmh)', 4)} AS avg_speed, {rounded('stddev_samp(trip_max_speed_kmh)', 4)} AS speed_std_dev,
    count(*) AS num_readings FROM silver WHERE event_year = '1998' GROUP BY CAST(event_timestamp AS DATE)""")
def ask_speed_trend(spark, d):
    return settle(questions.speed_trend(_silver(spark, d), "1998"), 4)


@query("nested_fields", f"""WITH {FLAT} SELECT event_id, car_chassis AS "carChassis", manufacturer AS "Manufacturer",
    engine_temp_celsius AS "engineTempCelsius", current_mileage_km AS "currentMileage",
    insurance_policy_number AS policy_number, tire_pressure_front_left_psi AS front_left FROM flat""")
def nested_fields(spark, d):
    return questions.nested_fields(events(spark, d))


@query("nested_filter", f"""WITH {FLAT} SELECT event_id, car_chassis AS "carChassis", manufacturer AS "Manufacturer",
    engine_temp_celsius AS "engineTempCelsius" FROM flat WHERE engine_temp_celsius > 90""")
def nested_filter(spark, d):
    return questions.hot_engines(events(spark, d))


@query("nested_group", f"""WITH {FLAT} SELECT manufacturer, count(*) AS total_records,
    {rounded('avg(engine_temp_celsius)', 4)} AS avg_engine_temp, {rounded('avg(trip_max_speed_kmh)', 4)} AS avg_speed
    FROM flat GROUP BY manufacturer""")
def nested_group(spark, d):
    return settle(questions.engine_by_manufacturer(events(spark, d)), 4)


@query("nested_hours_ago", f"""WITH {FLAT} SELECT event_id, car_chassis AS "carChassis", event_timestamp AS metric_time,
    engine_temp_celsius AS "engineTempCelsius",
    CAST(trunc(epoch(TIMESTAMP '2002-01-01 00:00:00' - event_timestamp) / 3600) AS BIGINT) AS hours_ago
    FROM flat ORDER BY event_timestamp DESC NULLS LAST, event_id LIMIT 20""")
def nested_hours_ago(spark, d):
    now = F.lit("2002-01-01 00:00:00").cast("timestamp")
    return settle(questions.most_recent_readings(events(spark, d), now))


@query("ask_expired", f"""WITH {STATE} SELECT car_chassis, manufacturer, model, insurance_valid_until, insurance_days_expired
    FROM state WHERE insurance_status = 'VENCIDO'""")
def ask_expired(spark, d):
    return questions.expired_vehicles(_state(spark, d))


@query("ask_status_count", f"WITH {STATE} SELECT insurance_status, count(*) AS total_vehicles FROM state GROUP BY insurance_status")
def ask_status_count(spark, d):
    return questions.vehicles_by(_state(spark, d), "insurance_status")


@query("ask_maker_count", f"WITH {STATE} SELECT manufacturer, count(*) AS total_vehicles FROM state GROUP BY manufacturer")
def ask_maker_count(spark, d):
    return questions.vehicles_by(_state(spark, d), "manufacturer")


@query("ask_efficiency_by_maker", f"""WITH {FUEL} SELECT manufacturer, {rounded('avg(km_per_liter)', 4)} AS avg_efficiency
    FROM fuel WHERE event_year = '1998' GROUP BY manufacturer""")
def ask_efficiency_by_maker(spark, d):
    return settle(questions.efficiency_by_manufacturer(_fuel(spark, d), "1998"), 4)


@query("ask_low_battery", f"WITH {STATE} SELECT car_chassis, battery_charge_percentage FROM state WHERE battery_charge_percentage < 20")
def ask_low_battery(spark, d):
    return questions.low_battery(_state(spark, d)).select("car_chassis", "battery_charge_percentage")


# --- quality and reconciliation -------------------------------------------------------

_CHECKS = Checks(
    required=("car_chassis", "model", "year", "current_mileage_km", "insurance_valid_until"),
    ranges={"engine_temp_celsius": (60, 100)}, unique="event_id", nested=(),
)


@query("fleet_quality_by_vehicle", f"""WITH {FLAT} SELECT car_chassis, record_count, duplicate_count, null_car_chassis, null_model,
    null_year, null_current_mileage_km, null_insurance_valid_until, out_of_range_engine_temp_celsius,
    0 AS error_count, warning_count, greatest(0, 100 - 5 * warning_count) AS quality_score, '' AS missing_columns,
    100 - 5 * warning_count >= 70 AS is_valid
    FROM (SELECT *, CAST((duplicate_count > 0)::INT + (null_car_chassis > 0)::INT + (null_model > 0)::INT + (null_year > 0)::INT
        + (null_current_mileage_km > 0)::INT + (null_insurance_valid_until > 0)::INT
        + (out_of_range_engine_temp_celsius > 0)::INT AS INT) AS warning_count
    FROM (SELECT car_chassis, count(*) AS record_count, count(*) - count(DISTINCT event_id) AS duplicate_count,
        count(*) - count(car_chassis) AS null_car_chassis, count(*) - count(model) AS null_model,
        count(*) - count(year) AS null_year, count(*) - count(current_mileage_km) AS null_current_mileage_km,
        count(*) - count(insurance_valid_until) AS null_insurance_valid_until,
        count(CASE WHEN engine_temp_celsius < 60 OR engine_temp_celsius > 100 THEN 1 END) AS out_of_range_engine_temp_celsius
        FROM flat GROUP BY car_chassis))""")
def fleet_quality_by_vehicle(spark, d):
    return quality_report(flatten_events(events(spark, d)), _CHECKS, by="car_chassis")


@query("fleet_row_score", f"""WITH {FLAT} SELECT event_id, processing_timestamp,
    greatest(0, 100 - 20 * ((current_mileage_km IS NULL)::INT + (insurance_valid_until IS NULL)::INT)
        - 5 * coalesce((engine_temp_celsius < 60 OR engine_temp_celsius > 100)::INT, 0)) AS data_quality_score FROM flat""")
def fleet_row_score(spark, d):
    scored = row_score(flatten_events(events(spark, d)), _CHECKS)
    return scored.select("event_id", "processing_timestamp", "data_quality_score")


@query("layer_side_by_side", f"""WITH {SILVER} SELECT event_id, trip_max_speed_kmh AS left_speed, trip_max_speed_kmh AS right_speed,
    engine_temp_celsius AS left_engine, engine_temp_celsius AS right_engine FROM silver""")
def layer_side_by_side(spark, d):
    """Nested and flat values of the event that survived deduplication."""
    nested = {"nested_speed": "trip_data.trip_summary.data.tripMaxSpeedKm",
              "nested_engine": "trip_data.vehicle_telemetry_snapshot.data.engineTempCelsius"}
    rows = flatten_events(events(spark, d), nested)
    survivor = ["processing_timestamp", "car_chassis", "trip_end_timestamp"]
    return beside_survivor(rows, "event_id", EVENT_RECENCY, survivor, {
        "speed": ("nested_speed", "trip_max_speed_kmh"), "engine": ("nested_engine", "engine_temp_celsius"),
    }, content_hash(rows, list(flatten.EVENT_PATHS)))


@query("reconcile_layers_summary", f"""WITH {SILVER},
    l AS (SELECT event_id, count(*) AS copies FROM flat GROUP BY event_id),
    r AS (SELECT event_id FROM silver WHERE event_year IS NOT NULL)
    SELECT CASE WHEN r.event_id IS NULL THEN 'missing_right' ELSE 'matched' END AS verdict, count(*) AS keys,
        CAST(sum(copies) AS BIGINT) AS left_rows, count(r.event_id) AS right_rows
    FROM l LEFT JOIN r ON l.event_id = r.event_id GROUP BY 1""")
def reconcile_layers_summary(spark, d):
    """Bronze ids against dated Silver ids (content is compared by ``reconcile_layers``)."""
    left = flatten_events(events(spark, d)).select("event_id")
    right = dated(_silver(spark, d)).select("event_id")
    return reconcile_summary(reconcile(left, right, "event_id", ["event_id"]))
