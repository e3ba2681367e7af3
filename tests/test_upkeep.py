"""Rules as data, sketches per day, catalog layouts, and counts from footers."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from wayfleet.operators import rules, sketches
from wayfleet.operators.rules import Reference, Rule
from wayfleet.schemas import record
from wayfleet.sinks import files
from wayfleet.sources import tables


def test_rules_over_columns_and_references(spark):
    rows = spark.createDataFrame([(1, 5.0, "a", 10), (2, None, "b", 20), (3, -1.0, None, 10), (4, 7.0, "zz", 99)], "id int, price double, kind string, at int")
    kinds = spark.createDataFrame([("a", 0.0, 6.0), ("a", 0.0, 6.0), ("b", 0.0, 1.0), (None, 0.0, 0.0)], "kind string, low double, high double")
    listed = (
        Rule("positive", "price > 0"), Rule("priced", "price IS NOT NULL", severity=rules.WARNING), Rule("known", "k.found"),
        Rule("in_range", "price BETWEEN k.low AND k.high", applies="k.found", nulls_break=True), Rule("late", "at < 50", applies="kind IS NULL OR kind > 'y'"))
    found = rules.checked(rows, listed, [Reference("k", kinds, {"kind": "kind"}, ["low", "high"])])
    assert {r.id: (r.broken_rules, r.rejected) for r in found.collect()} == {
        1: ([], False), 2: (["priced", "in_range"], True), 3: (["positive", "known"], True), 4: (["known", "late"], True)}
    assert rules.accepted(found).columns == rows.columns and [r.id for r in rules.accepted(found).collect()] == [1]
    report = {r.rule: (r.severity, r.broken, r.rows, r.broken_pct) for r in rules.report(found, listed).collect()}
    assert report == {"positive": ("error", 1, 4, 25.0), "priced": ("warning", 1, 4, 25.0), "known": ("error", 2, 4, 50.0), "in_range": ("error", 1, 4, 25.0), "late": ("error", 1, 4, 25.0)}
    plan = rules.report(found, listed)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rules_edges(spark):
    rows = spark.createDataFrame([], "id int, k int")
    rule = Rule("one", "id > 0")
    assert [tuple(r) for r in rules.report(rules.checked(rows, [rule]), [rule]).collect()] == [("one", "error", 0, 0, None)]
    assert rules.checked(rows, []).collect() == []
    with pytest.raises(ValueError):
        rules.checked(rows, [rule, rule])
    with pytest.raises(ValueError):
        rules.checked(rows, [rule], [Reference("k", rows, {"id": "id"})])


def test_united_sketches_are_within_their_error(spark):
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("user"), (F.col("id") % 30).cast("string").alias("day"))
    stored = sketches.sketches(rows, ["day"], "user")
    twice = sketches.merge(stored, stored, keys=["day"])
    found = sketches.estimates(twice.withColumn("all", F.lit(1)), ["all"]).first()
    assert abs(found.distinct_estimate - 20_000) <= 4 * sketches.error_of() * 20_000 and found.n_rows == 120_000
    assert sketches.estimates(stored.limit(0), ["day"]).collect() == []
    assert max(len(r.sketch) for r in stored.collect()) < 5_000


def test_catalog_takes_new_columns_and_touched_partitions(spark):
    path, database = tempfile.mkdtemp(prefix="run-"), f"db_{uuid.uuid4().hex[:8]}"
    old, new = record(id="bigint", day="string"), record(id="bigint", note="string", day="string")
    files.append(spark.createDataFrame([(1, "a"), (2, "it's")], old), path, ["day"])
    tables.create_external(spark, database, "t", old, path, ["day"])
    assert tables.evolve(spark, database, "t", old, ["day"]) == []
    assert tables.add_partitions(spark, database, "t", spark.createDataFrame([("a",)], "day string"), ["day"]) == 1
    assert [r.id for r in tables.table(spark, database, "t").collect()] == [1], "only the partition that was named"
    files.append(spark.createDataFrame([(3, "n", "b")], new), path, ["day"])
    assert tables.evolve(spark, database, "t", new, ["day"]) == ["note"]
    assert tables.add_partitions(spark, database, "t", spark.createDataFrame([("b",), ("it's",), ("b",)], "day string"), ["day"]) == 2
    assert sorted((r.id, r.note, r.day) for r in tables.table(spark, database, "t").collect()) == [(1, None, "a"), (2, None, "it's"), (3, "n", "b")]
    with pytest.raises(ValueError, match="id: bigint is not string"):
        tables.evolve(spark, database, "t", record(id="string", day="string"), ["day"])
    # A column of the table that a later layout lacks stays.
    assert tables.evolve(spark, database, "t", old, ["day"]) == [] and "note" in tables.table(spark, database, "t").columns
    assert tables.add_partitions(spark, database, "t", spark.createDataFrame([], "day string"), ["day"]) == 0


def test_counts_from_footers(spark):
    path, layout = tempfile.mkdtemp(prefix="run-"), record(id="bigint", day="string")
    files.append(spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("day")), path, ["day"])
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counts = files.footer_counts(spark, path, layout, ["day"])
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
    assert {r.day: r.n_rows for r in counts.collect()} == {"0": 334, "1": 333, "2": 333}
    assert files.footer_counts(spark, path, layout).collect()[0].n_rows == 1000 == files.written(spark, path, layout)["rows"]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
