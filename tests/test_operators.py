import itertools
import math
import random

import pytest
from pyspark.sql import functions as F
from samples import event, frame, legacy, scenarios

from wayfleet import schemas
from wayfleet.functions import alerts
from wayfleet.operators import flatten, monthly, quality
from wayfleet.operators.latest import duplicate_keys, latest_per_key, reduction_stats
from wayfleet.operators.ordered import quantiles
from wayfleet.operators.ranking import rank_all, rank_within, top_ranks
from wayfleet.operators.reconcile import reconcile, reconcile_summary
from wayfleet.operators.sections import custom_order, section, stack
from wayfleet.operators.summary import with_group_count, with_share
from wayfleet.operators.upsert import by_name, not_yet_stored, upsert_latest, within_partitions
from wayfleet.plans import gold
from wayfleet.plans.silver import flatten_events, legacy_silver, silver


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flatten_events_has_47_columns_and_silver_55(spark):
    bronze = frame(spark, [event()], schemas.EVENT)
    assert len(flatten_events(bronze).columns) == 47
    flat = silver(bronze, "2025-11-06")
    assert len(flat.columns) == 55
    row = flat.first()
    assert (row.tire_pressure_rear_right_psi, row.rental_customer_id, row.event_month) == (33.9, "CUST-1", "11")
    assert row.fuel_efficiency_l_per_100km == 10.16 and row.average_speed_calculated_kmh == 42.0


def test_generic_flatten_and_renaming(spark):
    flat = flatten.flatten_all(frame(spark, [legacy()], schemas.LEGACY_EVENT))
    assert len(flat.columns) == 31 and "metrics_trip_tripMileage" in flat.columns
    assert flatten.snake_case("fuelCapacityLiters") == "fuel_capacity_liters"
    assert flatten.snake_case("metrics_trip_tripMaxSpeedKm") == "metrics_trip_trip_max_speed_km"
    assert flatten.snake_case("ModelYear") == "model_year" and flatten.snake_case("VINCode") == "vin_code"
    with pytest.raises(ValueError):
        flatten.snake_columns(spark.createDataFrame([(1, 2)], "aB int, a_b int"))


def test_numbers_inside_structs_are_widened(spark):
    df = spark.createDataFrame([(1, (2, True, [3]), [(4,)])], "n int, s struct<a:int,b:boolean,c:array<int>>, l array<struct<x:bigint>>")
    types = {f.name: f.dataType.simpleString() for f in flatten.widen_nested_numbers(df).schema.fields}
    assert types == {"n": "int", "s": "struct<a:double,b:boolean,c:array<double>>", "l": "array<struct<x:double>>"}


def test_latest_is_total_and_repartition_proof(spark):
    rows = [("k", 1, None, f"p{i}") for i in range(50)] + [("j", None, 5, "x"), ("j", None, None, "y"), (None, 1, 1, "z")]
    df = spark.createDataFrame(rows, "k string, a int, b int, payload string")
    first = latest_per_key(df, ["k"], ["a", "b"])
    picked = {tuple(r) for r in first.collect()}
    for parts in (1, 3, 7):
        assert {tuple(r) for r in latest_per_key(df.repartition(parts), ["k"], ["a", "b"]).collect()} == picked
    assert ("j", None, 5, "x") in picked and len(picked) == 3
    assert {tuple(r) for r in latest_per_key(first, ["k"], ["a", "b"]).collect()} == picked
    assert "WindowGroupLimit" in plan_of(first) and "Partial" in plan_of(first)
    assert {tuple(r) for r in duplicate_keys(df, ["k"]).collect()} == {("k", 50), ("j", 2)}
    assert tuple(reduction_stats(df, ["k"]).first()) == (53, 3, 50, 94.3)


def test_state_follows_mileage_then_time(spark):
    rows = [event("a", "V", mileage=4321), event("b", "V", mileage=8500, at="2025-01-01T00:00:00Z"),
            event("c", "V", mileage=8500, at="2025-01-02T00:00:00Z"), event("d", "W", mileage=None)]
    state = gold.current_state(silver(frame(spark, rows, schemas.EVENT)), "2025-11-06")
    assert {(r.car_chassis, r.event_id, r.current_mileage_km) for r in state.collect()} == {("V", "c", 8500), ("W", "d", None)}
    assert len(state.columns) == 57


def test_scenarios(spark):
    flat = silver(frame(spark, scenarios(), schemas.EVENT), "2025-11-06")
    curated = {r.car_chassis[:6]: r for r in gold.curated_state(flat).collect()}
    assert len(gold.curated_state(flat).columns) == 49
    assert curated["VIN005"].oil_status == "LOW" and curated["VIN005"].fuel_status == "OK"
    assert curated["VIN001"].km_since_last_service == 1031
    state = {r.car_chassis[:6]: r.insurance_status for r in gold.current_state(flat, "2025-11-06").collect()}
    assert state == {"VIN001": "ATIVO", "VIN002": "ATIVO", "VIN003": "VENCENDO_EM_90_DIAS", "VIN004": "ATIVO",
                     "VIN005": "VENCENDO_EM_90_DIAS"}
    multi = gold.full_alert_log(flat).filter("car_chassis LIKE 'VIN005%'").collect()
    assert {(r.alert_type, r.alert_value) for r in multi} == {
        ("OVERHEAT_ENGINE", 105.0), ("OVERHEAT_OIL", 118.0), ("LOW_TIRE_PRESSURE", 28.5), ("LOW_BATTERY", 68.0)}
    upkeep = gold.full_alert_log(flat, alerts.MAINTENANCE_RULES).filter("car_chassis LIKE 'VIN005%'").collect()
    assert {(r.alert_type, r.alert_status) for r in upkeep} == {
        ("OIL_LOW", "LOW"), ("ENGINE_TEMP", "CRITICAL"), ("TIRE_PRESSURE", "LOW")}


def test_upserts(spark):
    stored = spark.createDataFrame([("v", "29", 4321, "s"), ("v", "28", 1, "s")], "k string, d string, m int, extra string")
    batch = spark.createDataFrame([("v", "29", 8500), ("w", "29", 2)], "k string, d string, m int")
    merged = upsert_latest(batch, stored, ["k", "d"], ["m"])
    assert {tuple(r) for r in merged.collect()} == {("v", "29", 8500, None), ("v", "28", 1, "s"), ("w", "29", 2, None)}
    assert [r.m for r in within_partitions(stored, batch, ["d"]).collect()] == [4321]
    fresh = not_yet_stored(batch, by_name(stored, stored), ["k"])
    assert [tuple(r) for r in fresh.collect()] == [("w", "29", 2)]


def _rounded(name):
    return name, F.round(name, 9)


def test_monthly_merge_is_associative(spark):
    rng = random.Random(7)
    rows = [event(f"e{i}", f"V{rng.randrange(4)}", f"2025-0{rng.randrange(1, 4)}-11T00:00:00Z", km=float(rng.randrange(500)),
                  litres=float(rng.randrange(30)), top_speed=rng.randrange(50, 120), model=f"M{i % 2}") for i in range(60)]
    rows += [event("neg", "V0", km=-1.0), event("none", "V0", litres=None), event("late", "V9", at="bad")]
    flat = silver(frame(spark, rows, schemas.EVENT), "2025-11-06").cache()
    key = ["car_chassis", "event_year", "event_month"]

    def table(*frames):
        done = monthly.finish(monthly.merge(*frames)).drop("last_updated").orderBy(*key)
        # Adding doubles in another order moves the last bits only.
        return done.withColumn(*_rounded("avg_fuel_efficiency_l_per_100km")).collect()

    whole = table(monthly.partials(flat))
    lots = [monthly.partials(flat.filter(F.pmod(F.hash("event_id"), F.lit(3)) == i)) for i in range(3)]
    for order in itertools.permutations(lots):
        assert table(*order) == whole
    assert table(monthly.merge(lots[0], lots[1]), lots[2]) == whole
    assert sum(r.trip_count for r in whole) == 60
    raw = plan_of(monthly.partials(flat)).split("InMemory")[0]
    assert "HashAggregate" in raw


def test_ranks_match_brute_force(spark):
    rng = random.Random(3)
    values = [rng.choice([None, *range(40)]) for _ in range(300)] + [39] * 20
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(5)

    def rank(v):
        if v is None:
            return 1 + sum(x is not None for x in values)
        return 1 + sum(x is not None and x > v for x in values)

    assert {(r.id, r["rank"]) for r in rank_all(df, "v").collect()} == {(i, rank(v)) for i, v in enumerate(values)}
    for k in (1, 5, 60, 1000):
        got = {(r.id, r["rank"]) for r in top_ranks(df, "v", k).collect()}
        assert got == {(i, rank(v)) for i, v in enumerate(values) if rank(v) <= k}
    few = spark.createDataFrame([(1, None), (2, None), (3, 7)], "id int, v int")
    assert {(r.id, r["rank"]) for r in top_ranks(few, "v", 2).collect()} == {(1, 2), (2, 2), (3, 1)}
    assert {r["rank"] for r in rank_within(few, ["id"], "v").collect()} == {1}
    assert rank_all(few.limit(0), "v").count() == 0


def test_share_and_fleet_size_need_no_global_window(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "s string, n bigint")
    shared = with_share(df, "n")
    assert {tuple(r) for r in shared.collect()} == {("a", 1, 25.0), ("b", 3, 75.0)}
    sized = with_group_count(df, "fleet")
    assert {r.fleet for r in sized.collect()} == {2}
    assert "Window" not in plan_of(shared) + plan_of(sized)


def test_sections(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    layout = {"a": "string", "b": "bigint", "c": "double"}
    parts = stack([section(df, "ONE", layout, {"a": F.col("a")}), section(df, "TWO", layout, {"b": F.col("b")})])
    assert {tuple(r) for r in parts.collect()} == {("ONE", "x", None, None), ("TWO", None, 1, None)}
    with pytest.raises(ValueError):
        section(df, "ONE", layout, {"z": F.col("a")})
    order = spark.range(1).select(custom_order(F.lit("B"), ["A", "B"]), custom_order(F.lit("?"), ["A", "B"])).first()
    assert tuple(order) == (2, 3)


def test_quality(spark):
    good = frame(spark, [legacy("A"), legacy("B")], schemas.LEGACY_EVENT)
    report = quality.quality_report(good).first()
    assert (report.quality_score, report.is_valid, report.duplicate_count) == (100, True, 0)
    poor = good.union(good).withColumn("year", F.when(F.col("carChassis") == "A", 1800)).drop("Model")
    row = quality.quality_report(poor).first()
    assert (row.error_count, row.missing_columns, row.duplicate_count, row.null_year, row.out_of_range_year) == (1, "model", 2, 2, 2)
    assert row.quality_score == 100 - 20 - 15 and not row.is_valid
    assert quality.gate(quality.quality_report(good)) and not quality.gate(quality.quality_report(poor))
    assert not quality.gate(quality.quality_report(good.limit(0), by="carChassis"))
    scored = quality.row_score(poor, quality.Checks()).select("carChassis", "data_quality_score").distinct().collect()
    assert {tuple(r) for r in scored} == {("A", 75), ("B", 60)}
    no_metrics = quality.quality_report(good.withColumn("metrics", F.lit(None).cast(good.schema["metrics"].dataType))).first()
    assert no_metrics.warning_count == 1


def test_outliers_and_imputation(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(100)] + [(100, 999.0), (101, None)], "id int, v double")
    assert [r.id for r in quality.unusual(df, "v").filter("is_outlier").collect()] == [100]
    gaps = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 5.0), ("a", None), ("b", None)], "g string, v double")
    filled = quality.fill_with_median(gaps, "v", "g").collect()
    assert sorted(str(r.v) for r in filled) == ["1.0", "3.0", "3.0", "5.0", "None"]


def test_reconcile(spark):
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "x")], "id int, v string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (4, "x")], "id int, v string")
    detail = reconcile(left, right, "id", ["v"])
    assert {tuple(r) for r in detail.collect()} == {(1, 2, 1, "matched"), (2, 1, 1, "changed"), (3, 1, 0, "missing_right"),
                                                    (4, 0, 1, "missing_left")}
    assert reconcile_summary(detail).count() == 4


def test_legacy_silver(spark):
    rows = [legacy(), legacy("C2", litres=0.0, until="bad"), legacy("C3", at="late", until="2025-11-01")]
    flat = {r.carChassis: r for r in legacy_silver(frame(spark, rows, schemas.LEGACY_EVENT), "2025-11-06").collect()}
    assert (flat["C1"].Manufacturer, flat["C1"].color, flat["C1"].carInsurance_provider) == ("Hyundai", "blue", "Porto Seguro")
    assert flat["C1"].metrics_trip_km_per_liter == 10.0 and flat["C1"].metrics_fuel_level_percentage == 50.0
    assert flat["C2"].metrics_trip_km_per_liter == 0.0 and flat["C2"].insurance_status == "ATIVO"
    assert flat["C3"].event_year is None and flat["C3"].insurance_days_expired == 5
    none = legacy_silver(frame(spark, rows[1:2], schemas.LEGACY_EVENT), "2025-11-06", empty_efficiency=None).first()
    assert none.metrics_trip_km_per_liter is None


def test_exact_quantiles_at_any_slicing(spark):
    """Exact whatever the number of slices, with ties, a hot value, NULLs and a NULL group."""
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(0, 500), 7])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for slices in ("2", "5", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", slices)
        try:
            got = {r.k: (r.q, r.m) for r in quantiles(df, "v", {"q": 0.25, "m": 0.5}, ["k"]).collect()}
            whole = quantiles(df, "v", {"q": 0.25, "m": 0.5}).first()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

        def exact(values, p):
            values = sorted(v for v in values if v is not None)
            return values[math.ceil(p * len(values)) - 1]

        assert got == {k: tuple(exact([v for key, v in rows if key == k], p) for p in (0.25, 0.5)) for k in ("a", "b", None)}
        assert tuple(whole) == tuple(exact([v for _, v in rows], p) for p in (0.25, 0.5))


def test_ranks_within_hot_groups_need_no_window_over_a_group(spark):
    rows = [("hot", n % 90) for n in range(3000)] + [("cold", 1), (None, None), (None, 4)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    ranked = rank_within(df, ["k"], "v")
    got = {(r.k, r.v): r["rank"] for r in ranked.collect()}
    assert ranked.count() == len(rows)
    for (k, v), place in got.items():
        mine = [x for key, x in rows if key == k]
        assert place == 1 + sum(x is not None and (v is None or x > v) for x in mine)
    # Running counts order values inside (group, slice); only one row per slice is ordered over a whole group.
    windows = [line for line in ranked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert windows and all("_slice" in line for line in windows)


def test_reconcile_sees_every_copy(spark):
    left = spark.createDataFrame([(1, 0), (1, 5), (1, 9), (2, 1), (2, 1), (3, 4)], "k int, v int")
    right = spark.createDataFrame([(1, 0), (1, 6), (1, 9), (2, 1), (3, 4), (4, 4)], "k int, v int")
    # Whatever the digests' order, a differing copy between equal ones shows.
    verdicts = {r.k: r.verdict for r in reconcile(left, right, "k", ["v"]).collect()}
    assert verdicts == {1: "changed", 2: "matched", 3: "matched", 4: "missing_left"}
