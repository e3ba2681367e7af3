"""Small literal inputs."""

from __future__ import annotations

import copy
import json


def event(event_id="e1", chassis="VIN-1", at="2025-11-06T10:00:00Z", processed="2025-11-06T10:00:45Z",
          mileage=8531, km=31.5, minutes=45, litres=3.2, top_speed=89, fuel=24.8, tank=50, engine=92, oil_temp=103,
          battery=78, oil=85.5, until="2026-10-29", service=7500, tires=(33.1, 33.0, 34.0, 33.9),
          maker="Hyundai", model="HB20") -> dict:
    def wrapped(source, **data):
        return {"extraction_timestamp": at, "source_system": source, "data": data}

    return {
        "event_id": event_id,
        "event_primary_timestamp": at,
        "processing_timestamp": processed,
        "carChassis": chassis,
        "vehicle_static_info": wrapped("fleet_db", Model=model, year=2024, ModelYear=2025, Manufacturer=maker,
                                       gasType="Flex", fuelCapacityLiters=tank, color="Blue"),
        "vehicle_dynamic_state": {
            "insurance_info": wrapped("insurance_api", provider="SafeAuto", policy_number="INS-1", validUntil=until),
            "maintenance_info": wrapped("service_db", last_service_date="2025-09-15", last_service_mileage=service,
                                        oil_life_percentage=oil),
        },
        "current_rental_agreement": wrapped("rental_ops_db", agreement_id="RENT-1", customer_id="CUST-1",
                                            rental_start_date="2025-11-01T10:00:00Z"),
        "trip_data": {
            "trip_summary": wrapped("trip_computer", tripStartTimestamp=at, tripEndTimestamp=at, tripMileage=km,
                                    tripTimeMinutes=minutes, tripFuelLiters=litres, tripMaxSpeedKm=top_speed),
            "vehicle_telemetry_snapshot": wrapped(
                "can_bus_poller", currentMileage=mileage, fuelAvailableLiters=fuel, engineTempCelsius=engine,
                oilTempCelsius=oil_temp, batteryChargePerc=battery,
                tire_pressures_psi=dict(zip(("front_left", "front_right", "rear_left", "rear_right"), tires))),
        },
    }


# The five described scenarios: chassis, mileage, service, km, min, L, top speed, fuel, tank, engine, oil temp,
# battery, oil life, insured until.
_SCENARIOS = [
    ("VIN001-HB20-2024-ABC123", 8531, 7500, 31.5, 45, 3.2, 89, 24.8, 50, 92, 103, 78, 85.5, "2026-10-29"),
    ("VIN002-CIVIC-2024-DEF456", 12058, 12000, 58.3, 75, 4.8, 110, 35.2, 47, 95, 108, 82, 92.0, "2026-06-15"),
    ("VIN003-COROLLA-2023-GHI789", 19043, 18500, 42.8, 75, 3.9, 95, 18.5, 50, 88, 98, 75, 65.0, "2025-12-31"),
    ("VIN004-ONIX-2024-JKL012", 5229, 5200, 28.7, 45, 2.8, 78, 32.5, 44, 90, 100, 80, 88.5, "2026-08-20"),
    ("VIN005-KICKS-2023-MNO345", 22585, 22000, 85.2, 105, 7.5, 120, 12.3, 41, 105, 118, 68, 45.0, "2025-11-15"),
]


def scenarios() -> list[dict]:
    made = []
    for i, (vin, miles, service, km, minutes, litres, top, fuel, tank, engine, oil_t, batt, oil, until) in enumerate(
        _SCENARIOS, start=1
    ):
        made.append(event(f"evt_00{i}", vin, f"2025-11-06T1{i}:00:00Z", f"2025-11-06T1{i}:00:45Z", miles, km, minutes,
                          litres, top, fuel, tank, engine, oil_t, batt, oil, until, service,
                          (28.5, 29.0, 30.0, 29.8) if i == 5 else (33.1, 33.0, 34.0, 33.9)))
    return made


FOREIGN = {"eventId": "evt-x", "vehicle": {"vin": "TEST"}, "driver": {"seatBeltEngaged": True}, "alerts": []}


def legacy(chassis="C1", mileage=4321, at="Wed, 29 Oct 2025 11:00:00", until="2026-10-29", litres=2.0, km=20,
           maker="hyundai", color="Blue ", fuel=25.0, tank=50) -> dict:
    return {
        "carChassis": chassis, "Model": "HB20", "year": 2024, "ModelYear": 2025, "Manufacturer": maker,
        "horsePower": 120, "gasType": "Flex", "currentMileage": mileage, "color": color, "fuelCapacityLiters": tank,
        "metrics": {"engineTempCelsius": 90, "oilTempCelsius": 100, "batteryChargePerc": 80,
                    "fuelAvailableLiters": fuel, "coolantCelsius": 85,
                    "trip": {"tripMileage": km, "tripTimeMinutes": 30, "tripFuelLiters": litres,
                             "tripMaxSpeedKm": 125, "tripAverageSpeedKm": 60, "tripStartTimestamp": at},
                    "metricTimestamp": at},
        "carInsurance": {"number": "N1", "provider": "porto seguro", "validUntil": until},
        "market": {"currentPrice": 60000, "currency": "BRL", "location": "SP", "dealer": "D", "warrantyYears": 3,
                   "evaluator": "E"},
    }


def frame(spark, records, schema):
    """Nested dicts -> DataFrame with the given schema."""
    from pyspark.sql import functions as F

    texts = spark.createDataFrame([(json.dumps(r),) for r in records], "t string")
    return texts.select(F.from_json("t", schema).alias("r")).select("r.*")


def variants(base: dict, count: int) -> list[dict]:
    return [copy.deepcopy(base) for _ in range(count)]
