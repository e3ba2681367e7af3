"""Registered queries against their SQL, and the pipeline's stages one by one."""

import glob
import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import rows_of
from wayfleet.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, db, name):
    df = queries.RUNS[name](spark, SF)
    cursor = db.execute(queries.SQL[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["op3_mixing", "op6_chat_format"])
def test_native_plans_run_no_python(spark, name):
    plan = queries.RUNS[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pipeline_stages(spark):
    """Each stage keeps a part of its input as it was; what it keeps is what its operator says of that input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, [r.doc_id for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF).persist()
        assert kept.columns == columns, name
        left = [r.doc_id for r in kept.collect()]
        assert len(left) == len(set(left)) and set(left) < set(ids), name
        docs, ids = kept, left
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in mixed} <= set(ids) and all(0 < r.mix_taken <= 3 * r.mix_size for r in mixed)
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(mixed)
