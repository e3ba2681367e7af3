"""Telemetry derived from the given tables.

``events`` turns every row of lineitem into one nested telemetry event, and
``legacy_events`` every row of orders into a first-generation record. Vehicles are
suppliers or customers, readings are arithmetic on the row, and the awkward cases
(redelivered ids, electric cars, missing or malformed values) occur throughout.
The same expressions, rendered for either dialect, give the SQL side its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfleet import schemas
from wayfleet.operators.flatten import EVENT_PATHS
from wayfleet.registry.base import rounded, table
from wayfleet.sources.tables import dealt_out, parts_for

# Expressions that the two dialects spell differently.
_SPARK = {
    "day_no": "datediff(CAST(l_shipdate AS DATE), DATE '1995-01-01')",
    "iso": lambda s: f"date_format(timestampadd(SECOND, CAST({s} AS INT), l_shipdate), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "day": lambda n: f"CAST(date_add(DATE '1998-09-02', CAST({n} AS INT)) AS STRING)",
}
_DUCK = {
    "day_no": "date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))",
    "iso": lambda s: f"strftime(l_shipdate + to_seconds({s}), '%Y-%m-%dT%H:%M:%SZ')",
    "day": lambda n: f"strftime(DATE '1998-09-02' + CAST({n} AS INT), '%Y-%m-%d')",
}


def _shared(d: dict) -> dict[str, str]:
    """Intermediate values several columns need."""
    return {
        "_taken": d["iso"]("(l_partkey % 86400)"),
        "_mileage": f"{d['day_no']} * 10 + l_partkey % 10",
        "_whole_price": "CAST(floor(l_extendedprice) AS BIGINT)",
    }


def _columns(d: dict, in_place: bool = False) -> dict[str, str]:
    """Flat column -> SQL expression over lineitem and the shared values; ``in_place``: over lineitem alone."""
    iso, day = d["iso"], d["day"]
    shared = {name: f"({text})" if in_place else name for name, text in _shared(d).items()}
    mileage, plain, tenths = shared["_mileage"], shared["_taken"], shared["_whole_price"]
    electric = "l_suppkey % 3 = 0"
    at = f"CASE WHEN l_partkey % 211 = 0 THEN concat({plain}, '?') ELSE {plain} END"

    def number(prefix: str, expression: str) -> str:
        return f"concat('{prefix}', CAST({expression} AS STRING))"

    return {
        "event_id": "concat('evt_', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING))",
        "event_timestamp": at,
        "processing_timestamp": iso("(l_partkey % 86400 + 5 + l_suppkey % 3600)"),
        "car_chassis": number("VIN-", "l_suppkey"),
        "static_info_timestamp": plain,
        "static_info_source": "'fleet_db'",
        "model": number("Model ", "l_suppkey % 5"),
        "year": "2015 + l_suppkey % 10",
        "model_year": "2016 + l_suppkey % 10",
        "manufacturer": number("Maker ", "l_suppkey % 7"),
        "fuel_type": f"CASE WHEN {electric} THEN 'Electric' ELSE 'Flex' END",
        "fuel_capacity_liters": f"CASE WHEN {electric} THEN 0 ELSE 40 + l_suppkey % 5 * 5 END",
        "color": "CASE WHEN l_suppkey % 2 = 0 THEN 'Blue' ELSE 'Black' END",
        "insurance_timestamp": plain,
        "insurance_source": "'insurance_api'",
        "insurance_provider": number("Insurer ", "l_suppkey % 4"),
        "insurance_policy_number": number("INS-", "l_suppkey"),
        "insurance_valid_until": (
            "CASE WHEN l_suppkey % 47 = 0 THEN NULL WHEN l_suppkey % 53 = 0 THEN 'unknown' "
            f"ELSE {day('l_suppkey * 13 % 400 - 150')} END"
        ),
        "maintenance_timestamp": plain,
        "maintenance_source": "'service_db'",
        "last_service_date": day("- (l_partkey % 300)"),
        "last_service_mileage": f"{mileage} - l_partkey * 7 % 12000",
        "oil_life_percentage": "CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_partkey * 37 % 1001 / 10e0 END",
        "rental_timestamp": plain,
        "rental_source": "'rental_ops_db'",
        "rental_agreement_id": number("RENT-", "l_orderkey"),
        "rental_customer_id": number("CUST-", "l_orderkey % 500"),
        "rental_start_date": plain,
        "trip_summary_timestamp": plain,
        "trip_summary_source": "'trip_computer'",
        "trip_start_timestamp": plain,
        "trip_end_timestamp": iso("(l_partkey % 86400 + l_partkey % 240 * 60)"),
        "trip_distance_km": f"{tenths} % 5000 / 10e0",
        "trip_duration_minutes": "l_partkey % 240",
        "trip_fuel_consumed_liters": f"CASE WHEN {electric} THEN 0e0 ELSE {tenths} % 400 / 10e0 END",
        "trip_max_speed_kmh": "40 + CAST(round(l_tax * 100) AS BIGINT) * 8 + l_partkey % 11",
        "telemetry_timestamp": plain,
        "telemetry_source": "'can_bus_poller'",
        "current_mileage_km": f"CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE {mileage} END",
        "fuel_available_liters": f"{tenths} % 450 / 10e0",
        "engine_temp_celsius": "55 + CAST(l_quantity AS BIGINT)",
        "oil_temp_celsius": "60 + CAST(round(l_discount * 100) AS BIGINT) * 5 + l_partkey % 7",
        "battery_charge_percentage": "l_partkey % 101",
        "tire_pressure_front_left_psi": "28 + l_partkey % 80 / 10e0",
        "tire_pressure_front_right_psi": "28 + l_orderkey % 80 / 10e0",
        "tire_pressure_rear_left_psi": "28 + l_suppkey % 80 / 10e0",
        "tire_pressure_rear_right_psi": "CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE 28 + l_linenumber % 80 / 10e0 END",
    }


def _nested(schema: T.StructType, by_path: dict[str, str], above: str = "") -> list[Column]:
    """Rebuild the nested layout from flat columns."""
    built = []
    for f in schema.fields:
        path = f"{above}{f.name}"
        if isinstance(f.dataType, T.StructType):
            built.append(F.struct(*_nested(f.dataType, by_path, f"{path}.")).alias(f.name))
        else:
            built.append(F.expr(by_path[path]).cast(f.dataType).alias(f.name))
    return built


def _kinds(schema: T.StructType, above: str = "") -> dict[str, T.DataType]:
    """Type of every path of a nested layout."""
    found: dict[str, T.DataType] = {}
    for f in schema.fields:
        found |= _kinds(f.dataType, f"{above}{f.name}.") if isinstance(f.dataType, T.StructType) else {f"{above}{f.name}": f.dataType}
    return found


_USED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_shipdate")

# Ship dates span seven years; folded onto four weeks they suit day-partitioned tables.
_FOLDED_SPARK = "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST({day_no} % 28 AS INT))"
_FOLDED_DUCK = "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({day_no} % 28 AS INT))"


# Beside the records if they are wanted in lots. A task that gathers them holds a few at a time, whatever the table's size.
LOT, LOTS_A_TASK = "_lot", 10


def events(spark: SparkSession, sf_dir: str, folded: bool = False, lots_of: int | None = None, in_order: bool = False) -> DataFrame:
    """lineitem as nested telemetry events; ``folded`` puts them all in four weeks, ``lots_of`` in lots of at most so many rows.

    ``in_order`` sorts the narrow rows of a task by day, so that files written of them pack better.

    Rows are dealt out by their event id while they are narrow. Whatever groups events by id then needs no
    second shuffle of the wide records, nor a sort on either side of it.

    All values are worked out in one step, from lineitem alone, and the records put together in the next, of plain columns. So
    Spark drops records that are only taken apart again. With values still to be worked out inside them it would build every record.
    """
    expressions, kinds = _columns(_SPARK, in_place=True), _kinds(schemas.EVENT)
    lines = table(spark, sf_dir, "lineitem")
    narrow = lines.select(*_USED, F.expr(expressions["event_id"]).alias("_event_id"))
    if lots_of:
        # A lot is numbered in the task that reads its rows, and rows are dealt out by lot in place of id: what gathers lots moves no records.
        n = lines.count()
        rows = narrow.withColumn(LOT, F.floor(F.monotonically_increasing_id() / lots_of)).repartition(
            max(parts_for(n, spark.sparkContext.defaultParallelism), -(-n // (LOTS_A_TASK * lots_of))), LOT)
    else:
        rows = dealt_out(narrow, "_event_id", rows=lines.count())  # told by the file's footer
    if folded:
        rows = rows.withColumn("l_shipdate", F.expr(_FOLDED_SPARK.format(**_SPARK)))
    if in_order:
        rows = rows.sortWithinPartitions("l_shipdate", "l_partkey")
    # What several columns share comes from one column; as they all refer to it, Spark keeps the two steps apart.
    alike = {name: short for name, text in _columns(_SPARK).items() for short in _shared(_SPARK) if text == short}
    expressions["event_id"] = "_event_id"
    own = [F.expr(text).cast(kinds[EVENT_PATHS[name]]).alias(name) for name, text in expressions.items() if name not in alike]
    lot = [LOT] if lots_of else []
    values = rows.select(*own, *(F.expr(text).alias(short) for short, text in _shared(_SPARK).items() if short in alike.values()), *lot)
    return values.select(*_nested(schemas.EVENT, {path: alike.get(name, name) for name, path in EVENT_PATHS.items()}), *lot)


def event_parts(spark: SparkSession, sf_dir: str) -> int:
    """Over how many tasks ``events`` deals its rows."""
    return parts_for(table(spark, sf_dir, "lineitem").count(), spark.sparkContext.defaultParallelism)


_BIGINTS = {
    "year", "model_year", "fuel_capacity_liters", "last_service_mileage", "trip_duration_minutes",
    "trip_max_speed_kmh", "current_mileage_km", "engine_temp_celsius", "oil_temp_celsius",
    "battery_charge_percentage",
}


def _flat_sql(folded: bool = False) -> str:
    parts = []
    for name, expression in _columns(_DUCK).items():
        if name == "event_timestamp":
            expression = f"try_strptime({expression}, '%Y-%m-%dT%H:%M:%SZ')"
        elif name in _BIGINTS:
            expression = f"CAST({expression} AS BIGINT)"
        parts.append(f"{expression} AS {name}")
    shared = ", ".join(f"{text} AS {name}" for name, text in _shared(_DUCK).items())
    rows = "lineitem"
    if folded:
        rows = f"(SELECT * REPLACE ({_FOLDED_DUCK.format(**_DUCK)} AS l_shipdate) FROM lineitem)"
    return f"SELECT {', '.join(parts)} FROM (SELECT *, {shared} FROM {rows})"


# --- first-generation records over orders ---------------------------------------------

_LEGACY_SPARK = {"when": "date_format(timestampadd(SECOND, CAST({s} AS INT), o_orderdate), 'EEE, dd MMM yyyy HH:mm:ss')"}
_LEGACY_DUCK = {"when": "strftime(o_orderdate + to_seconds({s}), '%a, %d %b %Y %H:%M:%S')"}


def legacy_columns(d: dict) -> dict[str, str]:
    """Nested path with ``_`` for dots -> SQL expression over orders."""
    when = d["when"].format(s="o_orderkey % 86400")
    whole = "CAST(floor(o_totalprice) AS BIGINT)"
    return {
        "carChassis": "concat('C', CAST(o_custkey AS STRING))",
        "Model": "concat('M', CAST(o_custkey % 9 AS STRING))",
        "year": "2010 + o_custkey % 15",
        "ModelYear": "2011 + o_custkey % 15",
        "Manufacturer": "CASE o_custkey % 3 WHEN 0 THEN 'hyundai' WHEN 1 THEN ' land ROVER' ELSE 'mercedes-benz' END",
        "horsePower": "80 + o_custkey % 200",
        "gasType": "'Flex'",
        "currentMileage": f"{whole} % 90000",
        "color": "CASE WHEN o_custkey % 2 = 0 THEN 'Blue ' ELSE 'BLACK' END",
        "fuelCapacityLiters": "o_custkey % 6 * 10",
        "metrics_engineTempCelsius": f"60 + {whole} % 50",
        "metrics_oilTempCelsius": f"70 + {whole} % 45",
        "metrics_batteryChargePerc": f"{whole} % 101",
        "metrics_fuelAvailableLiters": f"{whole} % 450 / 10e0",
        "metrics_coolantCelsius": f"70 + {whole} % 30",
        "metrics_trip_tripMileage": f"{whole} % 400",
        "metrics_trip_tripTimeMinutes": "o_orderkey % 180",
        "metrics_trip_tripFuelLiters": f"{whole} % 350 / 10e0",
        "metrics_trip_tripMaxSpeedKm": "40 + o_orderkey % 90",
        "metrics_trip_tripAverageSpeedKm": "20 + o_orderkey % 70",
        "metrics_trip_tripStartTimestamp": when,
        "metrics_metricTimestamp": f"CASE WHEN o_orderkey % 173 = 0 THEN 'late' ELSE {when} END",
        "carInsurance_number": "concat('N', CAST(o_custkey AS STRING))",
        "carInsurance_provider": "CASE WHEN o_custkey % 2 = 0 THEN 'porto seguro' ELSE 'ALLIANZ' END",
        "carInsurance_validUntil": (
            "CASE WHEN o_custkey % 31 = 0 THEN 'n/a' ELSE concat('1998-', "
            "CASE o_custkey % 4 WHEN 0 THEN '07' WHEN 1 THEN '09' WHEN 2 THEN '10' ELSE '12' END, '-02') END"
        ),
        "market_currentPrice": f"{whole} % 80000",
        "market_currency": "'BRL'",
        "market_location": "'SP'",
        "market_dealer": "concat('Dealer ', CAST(o_custkey % 11 AS STRING))",
        "market_warrantyYears": "o_custkey % 5",
        "market_evaluator": "'E'",
    }


def legacy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as first-generation records."""
    by_path: dict[str, str] = {}
    flat = legacy_columns(_LEGACY_SPARK)

    def collect(schema: T.StructType, above: str = "") -> None:
        for f in schema.fields:
            if isinstance(f.dataType, T.StructType):
                collect(f.dataType, f"{above}{f.name}.")
            else:
                by_path[f"{above}{f.name}"] = flat[f"{above}{f.name}".replace(".", "_")]

    collect(schemas.LEGACY_EVENT)
    return dealt_out(table(spark, sf_dir, "orders"), "o_orderkey").select(*_nested(schemas.LEGACY_EVENT, by_path))


# --- the SQL side: common table expressions -------------------------------------------

AS_OF = "1998-09-02"
_D = f"DATE '{AS_OF}'"

FLAT = f"flat AS ({_flat_sql()})"

_UNTIL = "try_cast(insurance_valid_until AS DATE)"

DERIVED = f"""
    CASE WHEN {_UNTIL} < {_D} THEN 'VENCIDO' ELSE 'ATIVO' END AS insurance_status,
    CASE WHEN {_UNTIL} < {_D} THEN CAST({_D} - {_UNTIL} AS INT) ELSE 0 END AS insurance_days_expired,
    {rounded('trip_fuel_consumed_liters / nullif(trip_distance_km, 0) * 100', 2)} AS fuel_efficiency_l_per_100km,
    {rounded('trip_distance_km / nullif(trip_duration_minutes / 60, 0)', 2)} AS average_speed_calculated_kmh,
    CASE WHEN oil_life_percentage < 20 THEN 'CRITICAL' WHEN oil_life_percentage < 50 THEN 'LOW' ELSE 'OK' END AS oil_status,
    strftime(event_timestamp, '%Y') AS event_year,
    strftime(event_timestamp, '%m') AS event_month,
    strftime(event_timestamp, '%d') AS event_day
"""

SILVER = f"""{FLAT},
once AS (
    SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id
            ORDER BY event_timestamp DESC NULLS LAST, processing_timestamp DESC NULLS LAST) AS place FROM flat
    ) WHERE place = 1
),
silver AS (SELECT *, {DERIVED} FROM once)"""



def folded_sql(sql: str) -> str:
    """The same query over ``events(..., folded=True)``."""
    return sql.replace(_flat_sql(), _flat_sql(True))


def state_sql(rows: str = "silver", folded: bool = False) -> str:
    """Current state over ``rows`` of Silver."""
    return f"""{folded_sql(SILVER) if folded else SILVER},
latest AS (
    SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY car_chassis
            ORDER BY current_mileage_km DESC NULLS LAST, event_timestamp DESC NULLS LAST,
                     processing_timestamp DESC NULLS LAST, event_id DESC NULLS LAST) AS place FROM {rows}
    ) WHERE place = 1
),
state AS (
    SELECT * REPLACE (
        CASE WHEN {_UNTIL} < {_D} THEN 'VENCIDO' WHEN {_UNTIL} - {_D} <= 90 THEN 'VENCENDO_EM_90_DIAS'
             ELSE 'ATIVO' END AS insurance_status,
        CASE WHEN {_UNTIL} < {_D} THEN CAST({_D} - {_UNTIL} AS INT) END AS insurance_days_expired
    ), TIMESTAMP '1998-09-02 06:00:00' AS gold_processing_timestamp, DATE '1998-09-02' AS gold_snapshot_date
    FROM latest
)"""


STATE = state_sql()

FUEL = f"""{SILVER},
trips AS (
    SELECT * FROM silver WHERE car_chassis IS NOT NULL AND event_year IS NOT NULL AND event_month IS NOT NULL
        AND trip_distance_km >= 0 AND trip_fuel_consumed_liters >= 0
),
fuel AS (
    SELECT car_chassis, event_year, event_month,
        max(manufacturer) AS manufacturer, max(model) AS model,
        round(sum(trip_distance_km), 4) AS total_mileage,
        round(sum(trip_fuel_consumed_liters), 4) AS total_fuel,
        CASE WHEN round(sum(trip_fuel_consumed_liters), 4) > 0
            THEN round(sum(trip_distance_km), 4) / round(sum(trip_fuel_consumed_liters), 4) END AS km_per_liter,
        count(*) AS trip_count,
        avg(trip_max_speed_kmh) AS avg_speed,
        CAST(max(trip_max_speed_kmh) AS DOUBLE) AS max_speed,
        avg(trip_duration_minutes) AS avg_trip_duration_minutes,
        avg(fuel_efficiency_l_per_100km) AS avg_fuel_efficiency_l_per_100km
    FROM trips GROUP BY car_chassis, event_year, event_month
)"""

ALERTS = f"""{SILVER},
alerts AS (
    SELECT car_chassis, event_timestamp,
        CASE WHEN engine_temp_celsius > 100 THEN 'OVERHEAT_ENGINE' WHEN oil_temp_celsius > 110 THEN 'OVERHEAT_OIL'
             ELSE 'SPEEDING_ALERT' END AS alert_type,
        CAST(CASE WHEN engine_temp_celsius > 100 THEN engine_temp_celsius WHEN oil_temp_celsius > 110
             THEN oil_temp_celsius ELSE trip_max_speed_kmh END AS DOUBLE) AS alert_value,
        event_year, event_month, event_day
    FROM silver WHERE engine_temp_celsius > 100 OR oil_temp_celsius > 110 OR trip_max_speed_kmh > 110
)"""


def legacy_flat_sql() -> str:
    numbers = {"currentMileage", "year", "ModelYear", "horsePower", "fuelCapacityLiters", "market_currentPrice",
               "market_warrantyYears"}
    parts = []
    for name, expression in legacy_columns(_LEGACY_DUCK).items():
        whole = name in numbers or (
            name.startswith("metrics_") and not name.endswith(("Liters", "Timestamp"))
        )
        parts.append(f'{"CAST(" + expression + " AS BIGINT)" if whole else expression} AS "{name}"')
    return "SELECT " + ", ".join(parts) + ", o_orderkey, o_orderdate FROM orders"


LEGACY_FLAT = f"flat AS ({legacy_flat_sql()})"
