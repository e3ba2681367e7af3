import datetime as dt
import json
import os
import tempfile

from samples import FOREIGN, event, scenarios

from wayfleet import schemas
from wayfleet.plans import medallion
from wayfleet.plans.medallion import Layout

AS_OF = dt.date(2025, 11, 6)


def drop(folder, name, payload):
    os.makedirs(folder, exist_ok=True)
    text = payload if isinstance(payload, str) else json.dumps(payload, indent=1)
    with open(os.path.join(folder, name), "w") as handle:
        handle.write(text)


def test_landing_to_products_is_incremental_and_repeatable(spark):
    base = tempfile.mkdtemp(prefix="run-")
    layout = Layout(f"{base}/landing", f"{base}/lake")
    five = scenarios()
    drop(layout.landing, "a.json", five[0])
    drop(layout.landing, "b.json", five[1:3])
    drop(layout.landing, "c.json", "\n".join(json.dumps(e) for e in five[3:]))
    drop(layout.landing, "foreign.json", FOREIGN)
    drop(layout.landing, "broken.json", '{"event_id": ')
    drop(layout.landing, "note.txt", "not data")
    drop(layout.landing, "_temp.json", five[0])
    medallion.run(spark, layout, AS_OF)

    assert medallion.read_silver(spark, layout).count() == 5
    rejects = {r.reject_reason for r in spark.read.parquet(layout.quarantine).collect()}
    assert rejects == {"foreign_layout", "not_json"}
    audit = {os.path.basename(r.source_file): r.status for r in spark.read.parquet(layout.audit).collect()}
    assert audit == {"a.json": "processed", "b.json": "processed", "c.json": "processed",
                     "foreign.json": "failed", "broken.json": "failed"}
    alerts = medallion.read_alerts(spark, layout).collect()
    assert [(a.alert_type, a.alert_value) for a in alerts] == [("OVERHEAT_ENGINE", 105.0)]

    state = {r.car_chassis[:6]: r for r in medallion.read_state(spark, layout).collect()}
    assert state["VIN005"].insurance_status == "VENCENDO_EM_90_DIAS"
    assert len(medallion.read_state(spark, layout).columns) == 57
    before = medallion.read_fuel(spark, layout).orderBy("car_chassis").drop("last_updated").collect()

    # Nothing new: nothing changes.
    medallion.run(spark, layout, AS_OF)
    assert medallion.read_silver(spark, layout).count() == 5
    assert medallion.read_fuel(spark, layout).orderBy("car_chassis").drop("last_updated").collect() == before

    # A redelivery, a late event in an old month, and a newer state.
    drop(layout.landing, "d.json", five[0])
    drop(layout.landing, "late.json", event("late", five[0]["carChassis"], "2025-01-02T00:00:00Z", mileage=10, km=10.0,
                                            litres=1.0))
    drop(layout.landing, "newer.json", event("newer", five[0]["carChassis"], "2025-11-07T00:00:00Z", mileage=9000,
                                             km=8.5, litres=0.8))
    medallion.run(spark, layout, AS_OF)
    assert medallion.read_silver(spark, layout).count() == 7
    fuel = {(r.car_chassis[:6], r.event_year, r.event_month): r for r in medallion.read_fuel(spark, layout).collect()}
    assert fuel["VIN001", "2025", "01"].total_mileage == 10.0
    assert fuel["VIN001", "2025", "11"].total_mileage == 40.0 and fuel["VIN001", "2025", "11"].trip_count == 2
    state = {r.car_chassis[:6]: r for r in medallion.read_state(spark, layout).collect()}
    assert state["VIN001"].current_mileage_km == 9000 and len(state) == 5

    # Rebuilding from Bronze gives the same tables.
    again = layout.rebuilt("g2")
    medallion.build(spark, again, AS_OF)
    key = ["car_chassis", "event_year", "event_month"]
    assert (medallion.read_fuel(spark, again).drop("last_updated").orderBy(*key).collect()
            == medallion.read_fuel(spark, layout).drop("last_updated").orderBy(*key).collect())
    assert medallion.read_silver(spark, again).count() == 7
    runs = spark.read.parquet(layout.runs).orderBy("batch_id").collect()
    assert [r.silver_rows for r in runs] == [5, 2] and runs[0].silver_columns == 55


def test_any_batching_gives_the_same_tables(spark):
    """A later copy on another day, one with a lower mileage, repeats without a time, and one that later gets a time; in one, two and six batches."""
    car = scenarios()[0]["carChassis"]
    deliveries = [
        event("x", car, "2025-11-05T08:00:00Z", mileage=500, km=1.0, litres=0.1), event("y", car, "2025-11-05T09:00:00Z", mileage=900, km=1.0, litres=0.1),
        event("u", car, "soon"), event("x", car, "2025-11-06T08:00:00Z", mileage=400, km=2.0, litres=0.2),
        event("y", car, "2025-12-05T10:00:00Z", mileage=300, km=5.0, litres=0.5), event("u", car, "soon"), event("late", car, "whenever"),
        event("late", car, "2025-11-07T00:00:00Z", mileage=350, km=1.0, litres=0.1), event("x", car, "2025-11-04T08:00:00Z", mileage=999, km=9.0, litres=0.9),
    ]
    seen = set()
    for per_batch in (9, 5, 2):
        base = tempfile.mkdtemp(prefix="run-")
        layout = Layout(f"{base}/landing", f"{base}/lake")
        for at in range(0, len(deliveries), per_batch):
            drop(layout.landing, f"{at}.json", deliveries[at : at + per_batch])
            medallion.run(spark, layout, AS_OF)
        flat = medallion.read_silver(spark, layout).select("event_id", "event_day", "trip_distance_km").collect()
        fuel = medallion.read_fuel(spark, layout).select("event_month", "total_mileage", "trip_count").collect()
        state = medallion.read_state(spark, layout).select("event_id", "current_mileage_km").collect()
        aside = medallion.read_undated(spark, layout).select("event_id").collect()
        seen.add(tuple(tuple(sorted(map(tuple, rows))) for rows in (flat, fuel, state, aside)))
    assert seen == {(
        (("late", "07", 1.0), ("x", "06", 2.0), ("y", "05", 5.0)), (("11", 3.0, 2), ("12", 5.0, 1)), (("x", 400),), (("u",),))}


def test_undated_events_are_kept_aside(spark):
    base = tempfile.mkdtemp(prefix="run-")
    layout = Layout(f"{base}/landing", f"{base}/lake")
    drop(layout.landing, "a.json", [event("ok"), event("bad", at="2025-11-06T10:00:00.123Z"), event("worse", at="soon")])
    medallion.run(spark, layout, AS_OF)
    assert [r.event_id for r in medallion.read_silver(spark, layout).collect()] == ["ok"]
    assert {r.event_id for r in spark.read.parquet(layout.undated).collect()} == {"bad", "worse"}
    partitions = [d for d in os.listdir(layout.silver) if d.startswith("event_year")]
    assert partitions == ["event_year=2025"]


def test_source_files_are_removed_after_commit(spark):
    base = tempfile.mkdtemp(prefix="run-")
    layout = Layout(f"{base}/landing", f"{base}/lake")
    for i in range(3):
        drop(layout.landing, f"{i}.json", event(f"e{i}"))
    medallion.run(spark, layout, AS_OF, clean="delete", files_per_batch=1)
    assert medallion.read_silver(spark, layout).count() == 3
    assert len(os.listdir(layout.landing)) < 3


def test_schema_of_products(spark):
    assert medallion.read_silver(spark, Layout("/nowhere", "/nowhere")).columns[-3:] == schemas.EVENT_PARTITIONS
    assert medallion.read_fuel(spark, Layout("/nowhere", "/nowhere")).count() == 0
