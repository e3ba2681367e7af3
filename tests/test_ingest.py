"""CSV lines with headers of their own, ingest by extension, and records parsed once."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from samples import FOREIGN, event

from wayfleet import schemas
from wayfleet.schemas import record
from wayfleet.sources import landing
from wayfleet.streaming import ingest

FLAT = record(id="bigint", name="string", value="double")


def drop(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as handle:
        handle.write(text)


def parsed(spark, folder, required=("id",)):
    lines = landing.landing_text(spark, folder, "*.csv", shape=landing.LINES)
    return {(os.path.basename(r.file_path), r.raw): ((r.id, r.name, r.value), r.reject_reason) for r in landing.parse_csv_lines(lines, FLAT, required).collect()}


def test_every_csv_file_has_its_own_header(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    drop(folder, "a.csv", 'id,name,value\n1,"a, ""b""",2.5\n2,,\n3,"",1\n4,x\n5,x,1,2\n6,"open,1\n7,"a"b,1\n8,x,much\n,x,1\n')
    drop(folder, "b.csv", "﻿VALUE, Name,other,ID\r\n1.5,n,o,10\r\n\r\n2.5,ü ü,,11\r\n")
    drop(folder, "c.csv", "name,value\nx,1\n")
    drop(folder, "d.csv", "id,id,name\n1,2,z\n")
    drop(folder, "e.csv", "id,name,value\n")
    got = parsed(spark, folder)
    assert {k[1]: v for k, v in got.items() if k[0] == "a.csv"} == {
        '1,"a, ""b""",2.5': ((1, 'a, "b"', 2.5), None), "2,,": ((2, None, None), None), '3,"",1': ((3, "", 1.0), None),
        "4,x": ((4, "x", None), "wrong_width"), "5,x,1,2": ((5, "x", 1.0), "wrong_width"), '6,"open,1': ((6, got["a.csv", '6,"open,1'][0][1], 1.0), "malformed_row"),
        '7,"a"b,1': ((7, "a", 1.0), "malformed_row"), "8,x,much": ((8, "x", None), "bad_value"), ",x,1": ((None, "x", 1.0), "missing_id")}
    assert [v for k, v in sorted(got.items()) if k[0] == "b.csv"] == [((10, "n", 1.5), None), ((11, "ü ü", 2.5), None)]
    assert [v[1] for k, v in got.items() if k[0] == "c.csv"] == ["foreign_layout"]
    assert [v for k, v in got.items() if k[0] == "d.csv"] == [((1, "z", None), None)]
    assert not [k for k in got if k[0] == "e.csv"]


def test_a_large_csv_in_several_splits(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    drop(folder, "big.csv", "name,id\n" + "".join(f'"n,{i}",{i}\n' for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        lines = landing.landing_text(spark, folder, "*.csv", shape=landing.LINES)
        rows = landing.parse_csv_lines(lines, FLAT, ["id"])
        assert lines.rdd.getNumPartitions() > 4
        assert rows.agg(F.count("*"), F.sum("id"), F.count_if(F.col("name") == F.concat(F.lit("n,"), "id")), F.count("reject_reason")).first()[:] == (60_000, 59_999 * 30_000, 60_000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ingest_by_extension(spark):
    base = tempfile.mkdtemp(prefix="run-")
    paths = ingest.Paths(f"{base}/in", *(f"{base}/{n}" for n in ("table", "quarantine", "audit", "summary", "checkpoints")))
    drop(f"{base}/in/x", "a.json", '{"id": 1, "name": "one", "value": 1}\n{"id": 2}\n{"name": "none"}\nnothing\n')
    drop(f"{base}/in/y z", "b.csv", "value,id\n2.5,3\nbad,4\n")
    spark.createDataFrame([(5, "five", 5.0), (None, "none", 0.0)], FLAT).coalesce(1).write.parquet(f"{base}/in/p")
    drop(f"{base}/in", "c.xml", "<a/>")
    ingest.ingest(spark, paths, FLAT, ["id"])
    drop(f"{base}/in/y z", "d.csv", "id,name,value\n6,six,6\n")
    drop(f"{base}/in", "noextension", "x")
    ingest.ingest(spark, paths, FLAT, ["id"])
    rows = spark.read.parquet(paths.table).collect()
    assert sorted((r.id, r.value) for r in rows if r.value) == [(1, 1.0), (3, 2.5), (5, 5.0), (6, 6.0)] and sorted(r.id for r in rows) == [1, 2, 3, 5, 6]
    assert {r.id: os.path.basename(r.source_file) for r in rows if r.id in (1, 3)} == {1: "a.json", 3: "b.csv"}
    reasons = sorted(r.reject_reason for r in spark.read.parquet(paths.quarantine).collect())
    assert reasons == ["bad_value", "missing_id", "missing_id", "not_json", "unknown_extension", "unknown_extension"]
    audit = {os.path.basename(r.source_file): (r.rows_loaded, r.rows_rejected, r.status) for r in spark.read.parquet(paths.audit).collect()}
    assert {k: v for k, v in audit.items() if not k.startswith("part-")} == {
        "a.json": (2, 2, "partial"), "b.csv": (1, 1, "partial"), "d.csv": (1, 0, "processed"), "c.xml": (0, 1, "failed"), "noextension": (0, 1, "failed")}
    seen = {(r["format"], r.batch_id): (r.rows_loaded, r.rows_rejected) for r in spark.read.parquet(paths.summary).collect()}
    assert seen == {("json", 0): (2, 2), ("csv", 0): (1, 1), ("parquet", 0): (1, 1), ("csv", 1): (1, 0)}
    with pytest.raises(ValueError, match="avro"):
        ingest.ingest(spark, paths, FLAT, ["id"], ("json", "avro"))
    with pytest.raises(ValueError, match="CSV"):
        ingest.ingest(spark, paths, schemas.EVENT, ["event_id"])


def test_plain_lines_are_told_from_others(spark):
    """Whatever closes the array that is put around a text, or follows the first value, is not taken for a plain record."""
    one = json.dumps(event())
    texts = {
        one: None, f"  {one}  ": None, f"{one} {one}": "trailing_content", f"{one},{one}": "trailing_content", one + "}": "trailing_content",
        f"{one}] [{{": "trailing_content", f"{one}],[{one}": "trailing_content", one + "]": "trailing_content", one[:-5]: "not_json", "": "not_json", "{}": "foreign_layout",
        json.dumps(FOREIGN): "foreign_layout", json.dumps({**event(), "note": "a ] b"}): None, json.dumps({**event(), "note": "{} x"}): None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "raw string").withColumns({"file_path": F.lit("f"), "file_size": F.lit(1), "file_time": F.lit(None).cast("timestamp")})
    got = {r.raw: r.reject_reason for r in landing.parse_landing(frame, schemas.EVENT).select("raw", "reject_reason").collect()}
    assert got == texts
