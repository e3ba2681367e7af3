"""What queries write and shuffle, on a few rows of their own."""

import datetime as dt
import glob
import os

import pytest

import __spark_entry__ as entry  # noqa: F401  fills the registry
from wayfleet import schemas
from wayfleet.operators import latest, monthly
from wayfleet.operators.flatten import EVENT_PATHS
from wayfleet.operators.reconcile import beside_survivor
from wayfleet.plans.silver import dated, flatten_events, silver
from wayfleet.registry import roundtrips
from wayfleet.registry.base import RUNS
from wayfleet.registry.fleet import events
from wayfleet.registry.telemetry import AS_OF
from wayfleet.session import scratch
from wayfleet.sinks import files
from wayfleet.sources import landing, tables as sources
from wayfleet.sources.tables import ROWS_A_TASK, parts_for

ROWS = 600


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """lineitem with copies of some events."""
    root = str(tmp_path_factory.mktemp("size"))
    rows = [(i // 3, i % 40, i % 7, i % 3 if i % 5 else 0, float(i % 50), 100.0 + i, 0.05, 0.02, dt.datetime(1996, 1, 1) + dt.timedelta(days=i % 50)) for i in range(ROWS)]
    schema = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_shipdate timestamp_ntz")
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/lineitem.parquet")
    return root


def scratched(spark, run, label):
    """The folder that a query made under ``label``, and its result."""
    scratch(spark, label)
    at = f"{spark.conf.get('spark.checkpoint.dir')}/wayfleet/{label}-*"
    before = set(glob.glob(at))
    found = run()
    (made,) = set(glob.glob(at)) - before
    return made, found


@pytest.mark.parametrize(("name", "label"), [
    ("json_lines_scan", "lines"), ("json_array_scan", "arrays"), ("ingest_roundtrip", "landing"), ("load_audit", "landing"), ("landing_rejects", "broken")])
def test_landing_text_takes_little_room(spark, tables, name, label):
    made, found = scratched(spark, lambda: RUNS[name](spark, tables).collect(), label)
    size = sum(os.path.getsize(f) for f in glob.glob(f"{made}/*.txt*"))
    assert 0 < size < ROWS * 400  # as plain text 1,600 bytes an event
    if name == "load_audit":
        assert [(r["rows_loaded"], r["rows_rejected"]) for r in found] == [(ROWS, 0)]
    elif name != "landing_rejects":
        assert len(found) == ROWS


@pytest.mark.parametrize("name", ["fleet_silver", "fleet_current_state", "report_quality", "fleet_fuel_merged"])
def test_wide_events_are_not_shuffled_by_id(spark, tables, name, monkeypatch):
    monkeypatch.setattr(sources, "FEWEST_ROWS", 100)
    plan = RUNS[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_event_id#" in plan and "hashpartitioning(event_id#" not in plan
    assert "REPARTITION_BY_COL" not in plan  # adaptive execution would size tasks by the narrow rows


def test_copies_of_an_event_meet_in_one_task(spark, tables, monkeypatch):
    monkeypatch.setattr(sources, "FEWEST_ROWS", 100)
    found = RUNS["fleet_silver"](spark, tables)
    ids = spark.read.parquet(f"{tables}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct().count()
    assert ids < ROWS and found.count() == found.select("event_id").distinct().count() == ids


def test_a_task_gets_no_more_rows_when_the_table_grows():
    assert [parts_for(n, 12) for n in (0, 24_999, 60_000, 600_000, 36_000_000, 216_000_000)] == [1, 1, 2, 12, 90, 540]
    assert all(n / parts_for(n, 1) <= ROWS_A_TASK for n in range(1, 10**7, 123_457))


def test_a_csv_line_is_taken_apart_once(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([(1, "a", 2.5), (2, "b,c", None)], "n int, s string, x double").coalesce(1).write.option("header", True).csv(path)
    found = landing.csv_rows(spark, path, schemas.record(n="bigint", s="string", x="double"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2  # one for lines, one for headers
    assert sorted(map(tuple, found.collect())) == [(1, "a", 2.5), (2, "b,c", None)]


def test_fuel_batches_write_down_only_what_totals_need(spark, tables):
    made, _ = scratched(spark, lambda: RUNS["fuel_batches_roundtrip"](spark, tables).collect(), "fuel-????????????")
    assert set(spark.read.parquet(made).columns) == {*monthly.INPUTS, "lot"}  # not the 55 of Silver


def test_published_state_writes_down_only_rows_that_may_win(spark, tables, monkeypatch):
    monkeypatch.setattr(sources, "FEWEST_ROWS", 100)
    made, _ = scratched(spark, lambda: RUNS["publish_roundtrip"](spark, tables).collect(), "state-????????????")
    rows = spark.read.parquet(made)
    assert rows.count() == rows.select("car_chassis", "first").distinct().count() < ROWS / 3  # not all events


def test_rows_that_may_be_latest_hold_the_latest(spark):
    rows = [(None, "a", 9), ("e1", "a", 9), ("e1", "b", 1), ("e2", "a", 3), ("e3", "b", None), ("e4", None, 2), (None, None, 1), ("e5", "a", 9)]
    df = spark.createDataFrame(rows, "id string, car string, n int").repartition(3, "id")
    kept = latest.may_be_latest(df, ["car"], ["n"], "id", 3)
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if r.id not in ("e2", "e3"))
    assert sorted(map(str, latest.latest_per_key(kept, ["car"], ["n"]).collect())) == sorted(map(str, latest.latest_per_key(df, ["car"], ["n"]).collect()))
    # The session has more shuffle partitions than the rows are dealt over; they are not dealt anew.
    plan = latest.may_be_latest(df, ["car"], ["n"], "id", 3)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning(id#" in line and "ENSURE_REQUIREMENTS" in line]


def test_layers_are_compared_in_one_pass(spark, tables, monkeypatch):
    monkeypatch.setattr(sources, "FEWEST_ROWS", 100)
    found = RUNS["layer_side_by_side"](spark, tables)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    silver = {r.event_id: r for r in RUNS["fleet_silver"](spark, tables).collect()}
    rows = found.collect()
    assert {r.event_id for r in rows} == set(silver)
    assert all((r.right_speed, r.right_engine) == (silver[r.event_id].trip_max_speed_kmh, silver[r.event_id].engine_temp_celsius) for r in rows)


def test_a_layer_agrees_with_its_survivor_but_null_with_nothing(spark):
    rows = [("a", 2, "x", 1), ("a", 1, "x", 2), ("a", 1, "y", 3), ("b", 1, None, 4), (None, 1, "x", 5), ("c", 1, "z", 6), ("c", 1, "z", 6)]
    df = spark.createDataFrame(rows, "id string, at int, car string, v int")
    found = beside_survivor(df, "id", ["at"], ["car"], {"v": ("v", "v")}, latest.content_hash(df))
    assert sorted(map(tuple, found.collect())) == [("a", 1, 1), ("a", 2, 1), ("c", 6, 6), ("c", 6, 6)]


def test_the_fuel_report_works_silver_out_once(spark, tables):
    plan = RUNS["report_fuel"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "recent-fuel" in plan and "lineitem" not in plan


@pytest.mark.parametrize("made", [
    lambda spark, at: RUNS["fleet_flatten"](spark, at),
    lambda spark, at: dated(silver(events(spark, at), AS_OF)).select("event_id", "car_chassis", *schemas.MONTH_PARTITIONS)], ids=["fleet_flatten", "compaction_roundtrip"])
def test_records_that_are_only_taken_apart_are_not_built(spark, tables, made):
    plan = made(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "struct" not in plan
    assert plan.count("timestampadd") <= 6  # a moment that nine columns share is worked out for them all


def test_records_hold_the_values_of_the_flat_columns(spark, tables):
    whole = spark.createDataFrame(events(spark, tables).collect(), schemas.EVENT)  # built for good
    names = list(EVENT_PATHS)
    rows = sorted(map(str, flatten_events(whole).select(*names).collect()))
    assert len(rows) == ROWS and rows == sorted(map(str, flatten_events(events(spark, tables)).select(*names).collect()))


def test_the_compacted_table_works_out_only_its_columns(spark, tables, monkeypatch):
    plans, write = [], roundtrips.settled

    def settled(df, path):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, path)

    monkeypatch.setattr(roundtrips, "settled", settled)
    found = RUNS["compaction_roundtrip"](spark, tables).collect()
    (plan,) = plans
    assert "l_shipdate" in plan and not [c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") if f"{c}#" in plan.split("Relation")[0]]
    kept = dated(silver(events(spark, tables), AS_OF)).groupBy(*schemas.MONTH_PARTITIONS).count()
    assert sorted((r.event_year, r.event_month, r.n, r.seen) for r in found) == sorted((*r, r[-1]) for r in kept.collect())


def test_monthly_events_are_the_dated_rows_of_silver(spark, tmp_path):
    """Copies with other moments, with equal ones but other vehicles, undated ones, and rows without an id."""
    at, later = dt.datetime(1996, 1, 31), dt.datetime(1996, 2, 1)
    rows = [(1, 7, 1, 1, at), (1, 7, 1, 1, later), (2, 7, 1, 1, at), (2, 7, 3601, 1, at), (3, 211, 1, 1, later), (3, 7, 1, 1, at), (4, 211, 1, 1, at),
            (5, 7, 1, 1, None), (None, 7, 1, 1, at), (None, 7, 1, 2, later), (6, 7, None, 1, at), (7, 7, 1, 1, at), (7, 7, 1, 1, at)]
    schema = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_shipdate timestamp_ntz")
    spark.createDataFrame([(*r[:4], 1.0, 100.0 + i, 0.05, 0.02, r[4]) for i, r in enumerate(rows)], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = events(spark, str(tmp_path))
    whole = {(r.event_id, r.event_year, r.event_month): r.car_chassis for r in dated(silver(made, AS_OF)).collect()}
    found = {(r.event_id, r.event_year, r.event_month): r.car_chassis for r in roundtrips._monthly_events(made).collect()}
    assert set(found) == set(whole) == {("evt_1_1", "1996", "02"), ("evt_2_1", "1996", "01"), ("evt_3_1", "1996", "01"), (None, "1996", "02"),
                                        ("evt_6_1", "1996", "01"), ("evt_7_1", "1996", "01")}
    assert {k: v for k, v in found.items() if k[0] != "evt_2_1"} == {k: v for k, v in whole.items() if k[0] != "evt_2_1"}
    assert found["evt_2_1", "1996", "01"] in ("VIN-1", "VIN-3601")


def test_broken_lines_are_parsed_once(spark, tables):
    made, found = scratched(spark, lambda: RUNS["landing_rejects"](spark, tables), "parsed")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert made in plan and "json" not in plan  # three outputs of what was written down
    parsed = spark.read.parquet(made)
    assert parsed.count() == ROWS and parsed.filter("(raw IS NULL) = (reject_reason IS NULL)").count() == ROWS  # text of the refused only
    rows = found.collect()
    assert sum(r.n for r in rows if r.event_id != "audit") == sum(r.n for r in rows if r.event_id == "audit") == ROWS


def test_bronze_of_one_day_is_written_by_the_tasks_that_parse_it(spark, tables, monkeypatch):
    monkeypatch.setattr(files, "spread", lambda *a: pytest.fail("rows were gathered"))
    monkeypatch.setattr(sources, "FEWEST_ROWS", 100)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    made, found = scratched(spark, lambda: RUNS["ingest_roundtrip"](spark, tables), "bronze")
    written = glob.glob(f"{made}/**/part-*", recursive=True)
    assert len(written) > 1 and all(f.endswith(".zstd.parquet") for f in written) and found.count() == ROWS
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_arrays_are_made_without_moving_records(spark, tables, monkeypatch):
    plans, write = [], roundtrips._write_text
    monkeypatch.setattr(roundtrips, "_write_text", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a))[1])
    assert RUNS["json_array_scan"](spark, tables).count() == ROWS
    (plan,) = plans
    assert plan.count("Exchange") == 1 and "l_tax" in next(x for x in plan.splitlines()[::-1] if "Project" in x)


def test_lots_hold_all_rows_and_no_more_than_asked_for(spark, tables):
    made = events(spark, tables, lots_of=7)
    sizes = [r["count"] for r in made.groupBy("_lot").count().collect()]
    assert sum(sizes) == ROWS and max(sizes) == 7 and len(sizes) >= ROWS / 7
    assert made.rdd.getNumPartitions() == -(-ROWS // 70)  # few lots a task
    assert sorted(map(str, made.drop("_lot").collect())) == sorted(map(str, events(spark, tables).collect()))
