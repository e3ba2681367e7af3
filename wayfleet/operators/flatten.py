"""From nested records to flat columns. Everything is resolved from the schema,
so no data is read while planning and nested column pruning keeps working."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, functions as F, types as T

# Where each column of the flat telemetry table comes from.
EVENT_COLUMNS = """
event_id                        event_id
event_timestamp                 event_primary_timestamp
processing_timestamp            processing_timestamp
car_chassis                     carChassis
static_info_timestamp           vehicle_static_info.extraction_timestamp
static_info_source              vehicle_static_info.source_system
model                           vehicle_static_info.data.Model
year                            vehicle_static_info.data.year
model_year                      vehicle_static_info.data.ModelYear
manufacturer                    vehicle_static_info.data.Manufacturer
fuel_type                       vehicle_static_info.data.gasType
fuel_capacity_liters            vehicle_static_info.data.fuelCapacityLiters
color                           vehicle_static_info.data.color
insurance_timestamp             vehicle_dynamic_state.insurance_info.extraction_timestamp
insurance_source                vehicle_dynamic_state.insurance_info.source_system
insurance_provider              vehicle_dynamic_state.insurance_info.data.provider
insurance_policy_number         vehicle_dynamic_state.insurance_info.data.policy_number
insurance_valid_until           vehicle_dynamic_state.insurance_info.data.validUntil
maintenance_timestamp           vehicle_dynamic_state.maintenance_info.extraction_timestamp
maintenance_source              vehicle_dynamic_state.maintenance_info.source_system
last_service_date               vehicle_dynamic_state.maintenance_info.data.last_service_date
last_service_mileage            vehicle_dynamic_state.maintenance_info.data.last_service_mileage
oil_life_percentage             vehicle_dynamic_state.maintenance_info.data.oil_life_percentage
rental_timestamp                current_rental_agreement.extraction_timestamp
rental_source                   current_rental_agreement.source_system
rental_agreement_id             current_rental_agreement.data.agreement_id
rental_customer_id              current_rental_agreement.data.customer_id
rental_start_date               current_rental_agreement.data.rental_start_date
trip_summary_timestamp          trip_data.trip_summary.extraction_timestamp
trip_summary_source             trip_data.trip_summary.source_system
trip_start_timestamp            trip_data.trip_summary.data.tripStartTimestamp
trip_end_timestamp              trip_data.trip_summary.data.tripEndTimestamp
trip_distance_km                trip_data.trip_summary.data.tripMileage
trip_duration_minutes           trip_data.trip_summary.data.tripTimeMinutes
trip_fuel_consumed_liters       trip_data.trip_summary.data.tripFuelLiters
trip_max_speed_kmh              trip_data.trip_summary.data.tripMaxSpeedKm
telemetry_timestamp             trip_data.vehicle_telemetry_snapshot.extraction_timestamp
telemetry_source                trip_data.vehicle_telemetry_snapshot.source_system
current_mileage_km              trip_data.vehicle_telemetry_snapshot.data.currentMileage
fuel_available_liters           trip_data.vehicle_telemetry_snapshot.data.fuelAvailableLiters
engine_temp_celsius             trip_data.vehicle_telemetry_snapshot.data.engineTempCelsius
oil_temp_celsius                trip_data.vehicle_telemetry_snapshot.data.oilTempCelsius
battery_charge_percentage       trip_data.vehicle_telemetry_snapshot.data.batteryChargePerc
tire_pressure_front_left_psi    trip_data.vehicle_telemetry_snapshot.data.tire_pressures_psi.front_left
tire_pressure_front_right_psi   trip_data.vehicle_telemetry_snapshot.data.tire_pressures_psi.front_right
tire_pressure_rear_left_psi     trip_data.vehicle_telemetry_snapshot.data.tire_pressures_psi.rear_left
tire_pressure_rear_right_psi    trip_data.vehicle_telemetry_snapshot.data.tire_pressures_psi.rear_right
"""

EVENT_PATHS: dict[str, str] = dict(line.split() for line in EVENT_COLUMNS.strip().splitlines())


def pick(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Select dotted ``paths`` under flat names, in mapping order."""
    return df.selectExpr(*(f"{path} AS `{name}`" for name, path in paths.items()))


def leaves(schema: T.StructType, separator: str = "_", _above: tuple[str, ...] = ()) -> Iterator[tuple[str, str]]:
    """``(flat name, dotted path)`` of every non-struct field, depth first."""
    for field in schema.fields:
        trail = (*_above, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from leaves(field.dataType, separator, trail)
        else:
            yield separator.join(trail), ".".join(f"`{step}`" for step in trail)


def flatten_all(df: DataFrame, separator: str = "_") -> DataFrame:
    """Flatten whatever structs the frame has; arrays and maps stay as they are."""
    return pick(df, dict(leaves(df.schema, separator)))


def snake_case(name: str) -> str:
    """``fuelCapacityLiters`` -> ``fuel_capacity_liters``; ``VINCode`` -> ``vin_code``."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+|[^A-Za-z\d_]+", name)
    return "_".join(w.lower() for w in words)


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename all top-level columns to snake case; a clash is an error."""
    renamed = {c: snake_case(c) for c in df.columns}
    if len(set(renamed.values())) < len(renamed):
        clash = sorted(n for n in renamed.values() if list(renamed.values()).count(n) > 1)
        raise ValueError(f"columns collide after renaming: {clash}")
    return df.withColumnsRenamed(renamed)


def _widen(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _widen(f.dataType), f.nullable) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_widen(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.IntegralType):
        return T.DoubleType()
    return dtype


def widen_nested_numbers(df: DataFrame) -> DataFrame:
    """Whole numbers inside structs become doubles, so that 3 and 3.2 share a type.

    Top-level columns and booleans keep their type.
    """
    changes = {}
    for field in df.schema.fields:
        inside = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType
        if isinstance(inside, T.StructType) and _widen(field.dataType) != field.dataType:
            changes[field.name] = F.col(f"`{field.name}`").cast(_widen(field.dataType))
    return df.withColumns(changes) if changes else df
