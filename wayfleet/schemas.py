"""Record layouts, as fixed values shared with the producers of the feeds."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def record(**fields: str | T.DataType) -> T.StructType:
    """A struct from ``name="type"`` pairs; nested structs are passed as they are.

    Built without a session, so layouts can be module constants.
    """
    return T.StructType(
        [T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind) for name, kind in fields.items()]
    )


def envelope(**payload: str | T.DataType) -> T.StructType:
    """Every sub-record carries when and where it was extracted plus its payload."""
    return record(extraction_timestamp="string", source_system="string", data=record(**payload))


# Current event layout.
EVENT = record(
    event_id="string",
    event_primary_timestamp="string",
    processing_timestamp="string",
    carChassis="string",
    vehicle_static_info=envelope(
        Model="string", year="bigint", ModelYear="bigint", Manufacturer="string",
        gasType="string", fuelCapacityLiters="bigint", color="string",
    ),
    vehicle_dynamic_state=record(
        insurance_info=envelope(provider="string", policy_number="string", validUntil="string"),
        maintenance_info=envelope(
            last_service_date="string", last_service_mileage="bigint", oil_life_percentage="double"
        ),
    ),
    current_rental_agreement=envelope(agreement_id="string", customer_id="string", rental_start_date="string"),
    trip_data=record(
        trip_summary=envelope(
            tripStartTimestamp="string", tripEndTimestamp="string", tripMileage="double",
            tripTimeMinutes="bigint", tripFuelLiters="double", tripMaxSpeedKm="bigint",
        ),
        vehicle_telemetry_snapshot=envelope(
            currentMileage="bigint", fuelAvailableLiters="double", engineTempCelsius="bigint",
            oilTempCelsius="bigint", batteryChargePerc="bigint",
            tire_pressures_psi=record(
                front_left="double", front_right="double", rear_left="double", rear_right="double"
            ),
        ),
    ),
)

# First-generation event layout (flat header, nested metrics).
LEGACY_EVENT = record(
    carChassis="string", Model="string", year="bigint", ModelYear="bigint", Manufacturer="string",
    horsePower="bigint", gasType="string", currentMileage="bigint", color="string", fuelCapacityLiters="bigint",
    metrics=record(
        engineTempCelsius="bigint", oilTempCelsius="bigint", batteryChargePerc="bigint",
        fuelAvailableLiters="double", coolantCelsius="bigint",
        trip=record(
            tripMileage="bigint", tripTimeMinutes="bigint", tripFuelLiters="double", tripMaxSpeedKm="bigint",
            tripAverageSpeedKm="bigint", tripStartTimestamp="string",
        ),
        metricTimestamp="string",
    ),
    carInsurance=record(number="string", provider="string", validUntil="string"),
    market=record(
        currentPrice="bigint", currency="string", location="string", dealer="string",
        warrantyYears="bigint", evaluator="string",
    ),
)

INGEST_PARTITIONS = ["ingest_year", "ingest_month", "ingest_day"]
EVENT_PARTITIONS = ["event_year", "event_month", "event_day"]
MONTH_PARTITIONS = ["event_year", "event_month"]
ALERT_PARTITIONS = ["alert_type", *EVENT_PARTITIONS]

LINEAGE = record(ingestion_timestamp="string", source_file="string", source_bucket="string")

BRONZE = T.StructType(
    EVENT.fields
    + LINEAGE.fields
    + [T.StructField(name, T.StringType()) for name in INGEST_PARTITIONS]
)

ALERT = record(
    car_chassis="string", event_timestamp="timestamp", alert_value="double",
    alert_type="string", event_year="string", event_month="string", event_day="string",
)


def empty(spark, schema: T.StructType):
    """A typed frame with no rows, for tables that do not exist yet."""
    return spark.createDataFrame([], schema)
