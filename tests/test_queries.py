"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry  # noqa: F401  fills the registry
from check import rows_of
from wayfleet.registry.base import RUNS, SQL

SF = "/root/testdata/sf0.001"
# Covered by test_flow and test_storage; too slow to repeat for every test run.
SLOW = {"landing_to_products", "catalog_roundtrip", "stream_alert_log", "stream_fuel_monthly", "fuel_batches_roundtrip",
        "compaction_roundtrip", "publish_roundtrip", "json_array_scan", "load_audit", "silver_any_batching"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(RUNS) == set(SQL)


@pytest.mark.parametrize("name", sorted(set(RUNS) - SLOW))
def test_query(spark, db, name):
    df = RUNS[name](spark, SF)
    cursor = db.execute(SQL[name])
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_no_python_workers_no_cross_joins_and_pruned_scans(spark):
    for name in ("fleet_silver", "fleet_current_state", "report_alerts", "report_insurance", "monthly_efficiency",
                 "rank_efficiency", "status_share", "reconcile_layers"):
        plan = RUNS[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    plan = RUNS["partition_prune"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in plan.split("PartitionFilters: ")[1].split("]")[0]
    plan = RUNS["monthly_efficiency"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "GreaterThanOrEqual(l_quantity,0.0)" in plan
