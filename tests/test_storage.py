import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from samples import FOREIGN, event, scenarios

from wayfleet import schemas
from wayfleet.operators import monthly
from wayfleet.plans.bronze import load_audit, require, to_bronze
from wayfleet.sinks import batches, files, snapshots
from wayfleet.sources import landing, tables
from wayfleet.streaming.sources import drain, parquet_stream

DAYS = "k string, n int, event_year string, event_month string"
PARTS = ["event_year", "event_month"]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_partition_values_stay_strings(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, "2025", "04")], DAYS)
    files.append(df, path, PARTS)
    assert spark.read.parquet(path).schema["event_month"].dataType.simpleString() == "string"
    again = spark.read.schema(df.schema).parquet(path).unionByName(df).groupBy(*PARTS).agg(F.sum("n").alias("n"))
    assert rows_of(again) == [("2025", "04", 2)]


def test_replace_and_rewrite_only_touch_their_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.append(spark.createDataFrame([("a", 1, "2025", "04"), ("b", 2, "2025", "05")], DAYS), path, PARTS)
    files.replace_partitions(spark.createDataFrame([("c", 3, "2025", "05")], DAYS), path, PARTS)
    stored = spark.read.schema(DAYS).parquet(path)
    assert rows_of(stored) == [("a", 1, "2025", "04"), ("c", 3, "2025", "05")]
    files.rewrite_partitions(stored.filter("event_month = '05'").withColumn("n", F.col("n") + 1), path, PARTS)
    assert rows_of(spark.read.schema(DAYS).parquet(path)) == [("a", 1, "2025", "04"), ("c", 4, "2025", "05")]
    assert not os.path.exists(f"{path}/_staged")


def test_interrupted_rewrite_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    files.append(spark.createDataFrame([("a", 1, "2025", "04")], DAYS), path, PARTS)
    staged = spark.createDataFrame([("a", 9, "2025", "04")], DAYS)
    staged.write.parquet(f"{path}/_staged")
    assert rows_of(spark.read.schema(DAYS).parquet(path)) == [("a", 1, "2025", "04")]
    assert files.finish_rewrite(spark, path, PARTS)
    assert rows_of(spark.read.schema(DAYS).parquet(path)) == [("a", 9, "2025", "04")]
    os.makedirs(f"{path}/_staged")  # started but not completed: discarded
    assert not files.finish_rewrite(spark, path, PARTS)
    assert rows_of(spark.read.schema(DAYS).parquet(path)) == [("a", 9, "2025", "04")]


def test_compaction_reduces_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        files.append(spark.createDataFrame([(f"k{i}", i, "2025", "04")], DAYS), path, PARTS)
    before = files.written(spark, path)
    files.compact(spark, path, spark.read.schema(DAYS).parquet(path).schema, PARTS)
    after = files.written(spark, path)
    assert before == {"files": 4, "rows": 4} and after == {"files": 1, "rows": 4}


def test_compaction_keeps_what_arrives_meanwhile(spark, tmp_path):
    """An interrupted compaction, then an append, then another one; nothing is lost or doubled, and a stream sees each row once."""
    path = str(tmp_path / "t")

    def put(key):
        files.append(spark.createDataFrame([(key, 1, "2025", "04")], DAYS), path, PARTS)

    def seen():
        writer = parquet_stream(spark, path, spark.createDataFrame([], DAYS).schema).writeStream.format("parquet").option("path", str(tmp_path / "seen"))
        drain(writer, str(tmp_path / "check"))
        return sorted(r.k for r in spark.read.parquet(str(tmp_path / "seen")).collect())

    put("a")
    put("b")
    assert seen() == ["a", "b"]
    schema = spark.createDataFrame([], DAYS).schema
    finish = files.finish_compaction
    try:  # the manifest is complete, but nothing is published yet
        files.finish_compaction = lambda *_: False
        files.compact(spark, path, schema, PARTS)
    finally:
        files.finish_compaction = finish
    put("c")
    files.compact(spark, path, schema, PARTS, F.col("event_month") == "04")
    assert rows_of(spark.read.schema(schema).parquet(path)) == [(k, 1, "2025", "04") for k in "abc"]
    assert files.written(spark, path)["files"] == 1
    os.makedirs(f"{path}/_compacting/data")  # started but not completed: dropped
    put("d")
    assert not files.finish_compaction(spark, path)
    assert rows_of(spark.read.schema(schema).parquet(path)) == [(k, 1, "2025", "04") for k in "abcd"]
    assert seen() == ["a", "b", "d"]  # "c" was compacted before this stream had read it, as the docstring warns
    with pytest.raises(AnalysisException):
        files.compact(spark, path, schema, PARTS, F.col("n") > 0)


def test_load_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    for load in (1, 2, 2):
        files.append_load(spark.createDataFrame([("a", load, "2025", "04")], DAYS), path, PARTS, load)
    assert [r.n for r in spark.read.parquet(path).orderBy("n").collect()] == [1, 2]


def test_snapshots_switch_when_complete(spark, tmp_path):
    root = str(tmp_path / "s")
    assert snapshots.current(spark, root) is None
    assert snapshots.current(spark, root, schemas.ALERT).count() == 0
    for n in range(1, 5):
        snapshots.publish(spark.createDataFrame([(n,)], "n int"), root)
    assert snapshots.versions(spark, root) == [3, 4]
    os.makedirs(snapshots.folder(root, 5))  # a crashed writer
    assert snapshots.current(spark, root).first().n == 4
    # A rewrite reads the version before the one it writes.
    snapshots.publish(snapshots.current(spark, root).withColumn("n", F.col("n") * 10), root)
    assert snapshots.current(spark, root).first().n == 40


def test_batches_apply_once(spark, tmp_path):
    root = str(tmp_path / "f")
    layout = monthly.partials(_silver(spark, [event()])).schema

    def total():
        merged = batches.merged(spark, root, layout, monthly.merge)
        return {(r.car_chassis, r.event_month): (r.total_mileage, r.trip_count) for r in merged.collect()}

    one = monthly.partials(_silver(spark, [event("a", km=10.0), event("b", km=5.0)]))
    two = monthly.partials(_silver(spark, [event("c", km=1.0), event("d", "V2", km=2.0)]))
    assert total() == {}
    assert batches.apply_batch(one, root, "0") and batches.apply_batch(one, root, "0")
    assert total() == {("VIN-1", "11"): (15.0, 2)}
    batches.fold(spark, root, layout, monthly.merge)
    assert not batches.apply_batch(one, root, "0")
    batches.apply_batch(two, root, "1")
    expected = {("VIN-1", "11"): (16.0, 3), ("V2", "11"): (2.0, 1)}
    assert total() == expected
    batches.fold(spark, root, layout, monthly.merge)
    assert total() == expected and sorted(r.applied for r in batches.folded_ids(spark, root).collect()) == ["0", "1"]
    # A fold that died before removing what it had folded.
    two.write.parquet(f"{root}/pending/batch_id=1")
    assert total() == expected


def _silver(spark, events):
    from samples import frame
    from wayfleet.plans.silver import silver

    return silver(frame(spark, events, schemas.EVENT), "2025-11-06")


def test_landing_shapes(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    a, b, c = event("a"), event("b"), event("c")
    put("one file%20x.json", json.dumps(a, indent=2))
    put("many.json", json.dumps([b, c], indent=2))
    put("lines.json", "\n".join(json.dumps(event(f"l{i}")) for i in range(3)) + "\n\n{broken}\n")
    put("mixed.json", json.dumps([event("m"), FOREIGN, {"event_id": "nokey"}]))
    put("empty.json", "  ")
    put("none.json", "[]")
    put("skip.csv", "x")
    put("_marker.json", json.dumps(a))
    parsed = landing.parse_landing(landing.landing_text(spark, str(tmp_path)), schemas.EVENT)
    assert {r.event_id for r in landing.accepted(parsed).collect()} == {"a", "b", "c", "l0", "l1", "l2", "m"}
    refused = {(os.path.basename(r.source_file), r.reject_reason) for r in landing.rejected(parsed).collect()}
    assert refused == {("lines.json", "not_json"), ("mixed.json", "foreign_layout"), ("mixed.json", "missing_carChassis"),
                       ("empty.json", "not_json"), ("none.json", "no_records")}
    raw = [r.raw for r in landing.rejected(parsed).filter("reject_reason = 'foreign_layout'").collect()]
    assert json.loads(raw[0]) == FOREIGN
    documents = landing.json_documents(spark, str(tmp_path / "m*.json"), schemas.EVENT)
    assert documents.filter("event_id IS NOT NULL").count() == 4


def test_landing_loses_nothing(spark, tmp_path):
    """Broken lines in first, middle and last place, two objects on a line, a pretty-printed pair: each in one file of either shape."""
    good = [json.dumps(event(f"g{i}")) for i in range(4)]
    texts = {
        "first.json": ["broken", *good[:2]], "middle.json": [good[0], "broken", good[1], good[2]], "last.json": [good[0], good[1], "{"],
        "twice.json": [f"{good[0]} {good[1]}", good[2]], "bracket.json": [good[0] + "] {}", good[1]], "brace.json": [good[0] + "} {}", good[1]],
    }
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    for shape in (landing.DOCUMENTS, landing.LINES):
        parsed = landing.parse_landing(landing.landing_text(spark, str(tmp_path), shape=shape), schemas.EVENT)
        ids = [r.event_id for r in landing.accepted(parsed).collect()]
        refused = sorted((os.path.basename(r.source_file), r.reject_reason) for r in landing.rejected(parsed).collect())
        assert sorted(ids) == sorted(["g0", "g1"] + ["g0", "g1", "g2"] + ["g0", "g1"] + ["g2"] + ["g1"] * 2)
        assert refused == [("brace.json", "trailing_content"), ("bracket.json", "trailing_content"), ("first.json", "not_json"),
                           ("last.json", "not_json"), ("middle.json", "not_json"), ("twice.json", "trailing_content")]
        assert len(ids) + len(refused) == sum(map(len, texts.values()))
        audit = {os.path.basename(r.source_file): (r.rows_loaded, r.rows_rejected, r.status) for r in load_audit(parsed).collect()}
        assert audit["middle.json"] == (3, 1, "partial") and audit["twice.json"] == (1, 1, "partial")
    pair = tmp_path / "pair"
    pair.mkdir()
    (pair / "pair.json").write_text(json.dumps(event("p"), indent=2) + "\n" + json.dumps(event("q"), indent=2))
    parsed = landing.parse_landing(landing.landing_text(spark, str(pair)), schemas.EVENT)
    assert [r.reject_reason for r in landing.rejected(parsed).collect()] == ["trailing_content"] and landing.accepted(parsed).count() == 0


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("B,n,a\nB1,1,A1\nB2,x,A2\nB3,3\n")
    wanted = "a string, b string, n int, absent double"
    schema = spark.createDataFrame([], wanted).schema
    assert [tuple(r) for r in landing.csv_rows(spark, str(tmp_path), schema).collect()] == [("A1", "B1", 1, None)]
    refused = landing.rejected(landing.parse_csv(spark, str(tmp_path), schema)).collect()
    assert sorted((r.reject_reason, r.raw) for r in refused) == [("bad_value", "B2,x,A2"), ("malformed_row", "B3,3")]


def test_bronze_of_a_retried_batch_lands_on_the_same_day(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps(event("e")))
    os.utime(tmp_path / "e.json", (1_700_000_000, 1_700_000_000))
    parsed = landing.parse_landing(landing.landing_text(spark, str(tmp_path)), schemas.EVENT)
    row = to_bronze(landing.accepted(parsed)).first()
    assert (row.ingest_year, row.ingest_month, row.ingest_day) == ("2023", "11", "14")


def test_readers(spark, tmp_path):
    flat = spark.createDataFrame([(1, "a")], "n int, s string")
    base = str(tmp_path / "mixed")
    flat.write.parquet(base)
    flat.write.mode("append").json(base)
    flat.write.mode("append").option("header", True).csv(base)
    assert landing.by_extension(spark, base, flat.schema).count() == 3
    with pytest.raises(ValueError):
        landing.by_extension(spark, base, flat.schema, ["xml"])
    with pytest.raises(ValueError, match="CSV"):
        landing.by_extension(spark, base, schemas.EVENT)
    paths = spark.createDataFrame([("s3a://bucket/in/a%20b.json",), ("file:///x/y+z.json",)], "p string")
    got = paths.select(landing.bucket_of(F.col("p")), landing.decoded_path(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("bucket", "s3a://bucket/in/a b.json"), (None, "file:///x/y z.json")]


def test_required_keys_ignore_case(spark):
    df = spark.createDataFrame([("a",), (None,)], "CarChassis string")
    usable, refused = require(df, ["carchassis"])
    assert usable.count() == 1 and refused.count() == 1
    usable, refused = require(df, ["nothing"])
    assert usable.count() == 0 and refused.count() == 2


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert tables.table_or_empty(spark, "shop", "alerts", schemas.ALERT).count() == 0
    tables.create_external(spark, "shop", "alerts", schemas.ALERT, path, schemas.ALERT_PARTITIONS)
    tables.create_external(spark, "shop", "alerts", schemas.ALERT, path, schemas.ALERT_PARTITIONS)
    row = ("c", None, 1.0, "T", "2025", "04", "03")
    files.append(spark.createDataFrame([row], schemas.ALERT), path, schemas.ALERT_PARTITIONS)
    tables.discover_partitions(spark, "shop", "alerts")
    assert tables.partitions_of(spark, "shop", "alerts").count() == 1
    found = tables.table_or_empty(spark, "shop", "alerts", schemas.ALERT).filter("event_month = '04'")
    assert found.count() == 1 and "PartitionFilters: [isnotnull" in found._jdf.queryExecution().executedPlan().toString()
    tables.alias_view(spark, "shop.alias", "shop", "alerts")
    assert not tables.is_empty(spark.table("shop.alias"))
    assert len(scenarios()) == 5
