"""Change feed, event-id index, and a Silver whose checkpoint is lost."""

import datetime as dt
import json
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F
from samples import event, scenarios

from wayfleet import schemas
from wayfleet.operators import monthly
from wayfleet.plans.bronze import to_bronze
from wayfleet.plans.gold import alert_log, fuel_monthly
from wayfleet.plans.silver import event_days, silver
from wayfleet.sinks import files, idindex
from wayfleet.sources import landing
from wayfleet.streaming import changes, jobs

AS_OF = dt.date(2025, 11, 6)


class Lake:
    """Bronze and Silver folders that batches of events are delivered to."""

    def __init__(self, spark):
        self.spark, self.base, self.loads = spark, tempfile.mkdtemp(prefix="run-"), 0
        self.feed, self.index, self.silver = (f"{self.base}/{n}" for n in ("changes", "ids", "silver"))
        self.layout = jobs.silver_schema(spark)

    def deliver(self, events, checkpoint="checkpoint", then=None):
        if events:
            texts = self.spark.createDataFrame([(json.dumps(e),) for e in events], "raw string").withColumns(
                {"file_path": F.lit("feed"), "file_size": F.lit(1), "file_time": F.lit("2025-11-06").cast("timestamp")})
            files.append_load(to_bronze(landing.accepted(landing.parse_landing(texts, schemas.EVENT))), f"{self.base}/bronze", schemas.INGEST_PARTITIONS, self.loads)
            self.loads += 1
        jobs.refresh_silver(self.spark, f"{self.base}/bronze", self.silver, f"{self.base}/undated", f"{self.base}/deltas",
                            f"{self.base}/{checkpoint}", AS_OF, then=then, feed=self.feed, index=self.index)

    def rows(self):
        return self.spark.read.schema(self.layout).parquet(self.silver)

    def signed(self):
        return self.spark.read.schema(changes.feed_schema(self.layout)).parquet(self.feed)

    def netted(self):
        return self.signed().groupBy("event_id", "event_day", "trip_distance_km").agg(F.sum(changes.SIGN).alias("n")).filter("n <> 0")


def test_difference_counts_copies(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, v string")
    found = changes.difference(before, after)
    assert sorted(map(tuple, found.collect()), key=str) == [(2, "b", -1), (3, "c", 1), (3, None, -1), (4, None, 1)]
    assert changes.difference(after, after).collect() == []


def test_a_batch_is_merged_and_compared_in_one_pass(spark):
    layout = "k int, t int, v string"
    before = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 1, "c"), (4, 1, None), (None, 1, "n")], layout)
    new = spark.createDataFrame([(1, 1, "a"), (2, 2, "B"), (3, 0, "old"), (5, 1, "e"), (None, 2, "N")], layout)
    found = changes.merged_changes(before, new, ["k"], ["t"])
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        (1, 1, "a", 0), (2, 1, "b", -1), (2, 2, "B", 1), (3, 1, "c", 0), (4, 1, None, 0), (5, 1, "e", 1), (None, 1, "n", -1), (None, 2, "N", 1)], key=str)
    after = found.filter("change >= 0").drop("change")
    assert sorted(map(tuple, changes.difference(before, after).collect()), key=str) == sorted(map(tuple, found.filter("change <> 0").collect()), key=str)


def test_only_refused_text_is_held(spark):
    texts = spark.createDataFrame([(json.dumps(event("a")),), ("{broken",)], "raw string").withColumns(
        {"file_path": F.lit("f"), "file_size": F.lit(1), "file_time": F.lit("2025-11-06").cast("timestamp")})
    parsed = jobs.without_used_text(landing.parse_landing(texts, schemas.EVENT))
    assert sorted((r["event_id"], r["raw"]) for r in parsed.collect() if r["event_id"]) == [("a", None)]
    assert [r["raw"] for r in landing.rejected(parsed).collect()] == ["{broken"]


def fleet(spark):
    cars = [s["carChassis"] for s in scenarios()]
    return [
        [event("x", cars[0], "2025-11-05T08:00:00Z", mileage=5, km=500.0, litres=50.0, engine=130), event("y", cars[0], "2025-11-05T09:00:00Z", mileage=9, km=1.5, litres=0.1)],
        [event("x", cars[0], "2025-11-06T08:00:00Z", mileage=4, km=2.25, litres=0.2), event("z", cars[1], "2025-12-05T10:00:00Z", mileage=3, km=5.0, litres=0.5, engine=120)],
        [event("y", cars[0], "2025-12-05T09:00:00Z", mileage=8, km=3.0, litres=0.3), event("z", cars[1], "2025-12-05T10:00:00Z", mileage=3, km=5.0, litres=0.5, engine=120)],
    ]


def test_products_follow_a_rewritten_silver(spark):
    """Streams on the feed run after every batch and equal one pass over Silver each time, after events changed, moved and came twice."""
    lake = Lake(spark)
    for batch in fleet(spark):
        lake.deliver(batch)
        changes.accumulate_fuel(spark, lake.feed, lake.layout, f"{lake.base}/fuel", f"{lake.base}/c-fuel")
        changes.log_alerts(spark, lake.feed, lake.layout, f"{lake.base}/alerts", f"{lake.base}/c-alerts")
        key = ["car_chassis", "event_year", "event_month"]
        got = monthly.finish(changes.read_fuel(spark, f"{lake.base}/fuel", lake.layout)).drop("last_updated").orderBy(*key).collect()
        want = fuel_monthly(lake.rows()).drop("last_updated").orderBy(*key).collect()
        # The feed sums decimals, the other one doubles.
        assert [tuple(pytest.approx(v) for v in r) for r in got] == [tuple(r) for r in want]
        logged = sorted(map(tuple, changes.read_alerts(spark, f"{lake.base}/alerts").collect()), key=str)
        assert logged == sorted(map(tuple, alert_log(lake.rows()).select(*schemas.ALERT.names).collect()), key=str)
    assert changes.went(lake.signed()).count() == 2 and len(logged) == 1
    assert sorted((r.event_id, r.n) for r in lake.netted().collect()) == [("x", 1), ("y", 1), ("z", 1)]


def test_a_new_checkpoint_takes_nothing_for_done(spark):
    """The checkpoint is lost after a batch, also in the middle of one: later input is in Silver, the feed nets to Silver, no delta is stale."""
    lake, (one, two, three) = Lake(spark), fleet(spark)
    lake.deliver(one)
    lake.deliver(two, checkpoint="second")
    assert lake.rows().count() == 3

    def broken(change, batch_id):
        raise RuntimeError("lost in the middle")

    with pytest.raises(Exception, match="lost in the middle"):
        lake.deliver(three, checkpoint="second", then=broken)
    seen = []
    lake.deliver([], checkpoint="third", then=lambda change, batch_id: seen.append(sorted(r.event_id for r in change.added.collect())))
    assert seen[0] == ["y"], "what the lost checkpoint had written down is finished first"
    assert {(r.event_id, r.event_day) for r in lake.rows().collect()} == {("x", "06"), ("y", "05"), ("z", "05")}
    assert {(r.event_id, r.event_day, r.n) for r in lake.netted().collect()} == {("x", "06", 1), ("y", "05", 1), ("z", "05", 1)}


def test_feed_is_published_whole_and_once(spark):
    lake = Lake(spark)
    rows = spark.createDataFrame([(1, 1)], "id int, change int")
    changes.publish(rows, lake.feed, "a-0")
    changes.publish(rows.union(rows), lake.feed, "a-0")
    assert spark.read.parquet(lake.feed).count() == 1 and files.folder_names(spark, lake.feed) == ["batch=a-0"]


def test_index_finds_every_stored_id(spark):
    base, draw = tempfile.mkdtemp(prefix="run-"), random.Random(1)
    stored = [(f"e{i}", "2025", "11", f"{draw.randint(1, 28):02d}") for i in range(3000)]
    for load in range(3):
        idindex.record_load(spark.createDataFrame(stored[load::3], idindex.DAYS), base, f"l{load}", buckets=8)
    asked = spark.createDataFrame([(f"e{i}",) for i in range(2900, 8000)], "event_id string")
    want = sorted(stored[2900:])
    assert sorted(map(tuple, idindex.lookup(asked, base, idindex.DAYS, buckets=8).collect())) == want
    # Of 15,000 questions to filters about ids that are nowhere, about one in a hundred passes.
    passed = idindex.candidates(asked.filter("event_id >= 'e3' AND length(event_id) = 5"), base, buckets=8)
    assert passed.join(spark.createDataFrame(stored, idindex.DAYS), "event_id", "left_anti").count() < 600
    # A repeated load changes nothing; merged loads answer the same.
    idindex.record_load(spark.createDataFrame(stored[:1], idindex.DAYS), base, "l0", buckets=8)
    assert idindex.merge_loads(spark, base, idindex.DAYS, "all", buckets=8) == 3
    assert sorted(map(tuple, idindex.lookup(asked, base, idindex.DAYS, buckets=8).collect())) == want
    assert idindex.loads(spark, base).select("load_id").distinct().count() == 1


def test_new_ids_open_no_entries(spark):
    """Folders of the index are pruned by what the filters say; a batch of new ids opens none, and Silver's ids are in no plan."""
    base = tempfile.mkdtemp(prefix="run-")
    idindex.record_load(spark.createDataFrame([(f"e{i}", "2025", "11", "05") for i in range(2000)], idindex.DAYS), base, "l0", buckets=16)

    def opened(ids):
        asked = spark.createDataFrame([(i,) for i in ids], "event_id string")
        found = idindex.lookup(asked, base, idindex.DAYS, buckets=16)
        return [r.event_id for r in found.collect()], idindex.candidates(asked, base, buckets=16).select("load_id", "bucket").distinct().collect()

    rows, folders = opened(["e17"])
    assert rows == ["e17"] and len(folders) == 1
    rows, folders = opened(["new-1", "new-2", "new-3"])
    assert rows == [] and len(folders) <= 1
    asked = spark.createDataFrame([("e17",)], "event_id string")
    plan = idindex.lookup(asked, base, idindex.DAYS, buckets=16)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*load_id#\d+ = l0", plan) and re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", plan)


def test_a_batch_moves_its_rows_once(spark, monkeypatch):
    """Rows of a batch are shuffled by id for its own copies; the merge with stored rows moves only those."""
    lake, plans, write = Lake(spark), [], jobs.write_apart

    def write_apart(df, path, kind):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, kind)

    monkeypatch.setattr(jobs, "write_apart", write_apart)
    for batch in fleet(spark)[:2]:
        lake.deliver(batch)
    assert plans[1].count("hashpartitioning(event_id#") == 2
    written = set(files.folder_names(spark, f"{lake.base}/deltas/{files.folder_names(spark, f'{lake.base}/deltas')[0]}/batch=1"))
    assert written == {"new_days", "days", "signed"}  # Silver of the batch alone is not written down
    assert lake.rows().count() == 3


def test_published_rows_are_moved_not_copied(spark):
    """The folder is renamed into the feed; a repetition finds it there, and a batch without changes publishes an empty one."""
    lake, (one, two, _) = Lake(spark), fleet(spark)
    lake.deliver(one)
    at = f"{lake.base}/deltas/{files.folder_names(spark, f'{lake.base}/deltas')[0]}"
    assert files.folder_names(spark, f"{at}/batch=0/signed") == []  # no kept rows, and the others are in the feed

    def broken(change, batch_id):
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        lake.deliver(two, then=broken)
    lake.deliver([])
    assert {(r.event_id, r.event_day) for r in lake.rows().collect()} == {("x", "06"), ("y", "05"), ("z", "05")}
    assert {(r.event_id, r.event_day, r.n) for r in lake.netted().collect()} == {("x", "06", 1), ("y", "05", 1), ("z", "05", 1)}
    lake.deliver(two)
    assert len(files.folder_names(spark, lake.feed)) == 3 and lake.netted().count() == 3
    assert spark.read.schema(changes.feed_schema(lake.layout)).parquet(f"{lake.feed}/{files.folder_names(spark, lake.feed)[-1]}").count() == 0


def test_undated_rows_stay_apart(spark):
    """An event that comes without a time, whether or not it is stored already, leaves Silver alone and is kept as undated."""
    lake, car = Lake(spark), scenarios()[0]["carChassis"]
    lake.deliver([event("x", car, "2025-11-05T08:00:00Z"), event("u", car, "soon")])
    lake.deliver([event("x", car, "never"), event("v", car, "later"), event("w", car, "2025-11-06T08:00:00Z"), event("w", car, "?")])
    assert {(r.event_id, r.event_day) for r in lake.rows().collect()} == {("x", "05"), ("w", "06")}
    kept = spark.read.schema(lake.layout).parquet(f"{lake.base}/undated")
    assert sorted(r.event_id for r in kept.collect()) == ["u", "v", "x"]
    assert {(r.event_id, r.n) for r in lake.netted().collect()} == {("x", 1), ("w", 1)}


def test_a_batch_that_an_older_release_wrote_down_is_finished(spark):
    """Its rows stand in one folder and its Silver in another; a new checkpoint finishes it."""
    lake, (one, two, _) = Lake(spark), fleet(spark)
    lake.deliver(one)

    def broken(change, batch_id):
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        lake.deliver([*two, event("u", scenarios()[0]["carChassis"], "soon")], then=broken)
    stream = files.folder_names(spark, f"{lake.base}/deltas")[0]
    at, name = f"{lake.base}/deltas/{stream}/batch=1", f"batch={stream}-1"
    signed = changes.feed_schema(lake.layout)
    parts = [spark.read.schema(signed).parquet(f"{lake.feed}/{name}"), spark.read.schema(signed).parquet(f"{at}/signed/kind=kept")]
    aside = spark.read.schema(signed).parquet(f"{at}/signed/kind=undated").drop(changes.SIGN)
    parts[0].union(parts[1]).write.parquet(f"{at}/merged")
    changes.came(parts[0]).union(aside).write.parquet(f"{at}/new")
    for path in (f"{at}/signed", f"{lake.feed}/{name}", f"{lake.base}/undated", f"{lake.base}/ids"):
        files.remove(spark, path)
    lake.deliver([], checkpoint="second")
    assert {(r.event_id, r.event_day) for r in lake.rows().collect()} == {("x", "06"), ("y", "05"), ("z", "05")}
    assert {(r.event_id, r.event_day, r.n) for r in lake.netted().collect()} == {("x", "06", 1), ("y", "05", 1), ("z", "05", 1)}
    assert {r.event_id for r in spark.read.schema(lake.layout).parquet(f"{lake.base}/undated").collect()} == {"u"}


def test_event_days_are_those_of_silver(spark):
    cars = [s["carChassis"] for s in scenarios()]
    batch = [event("a", cars[0], "2025-11-05T08:00:00Z"), event("a", cars[0], "2025-12-06T08:00:00Z"), event("b", cars[1], "?"), event("b", cars[1], "2025-01-01T00:00:00Z"),
             event("c", cars[0], "?"), event(None, cars[0], "2025-11-07T08:00:00Z"), event(None, cars[1], "2025-11-08T08:00:00Z")]
    rows = spark.createDataFrame([(json.dumps(e),) for e in batch], "raw string").select(F.from_json("raw", schemas.EVENT).alias("r")).select("r.*")
    columns = ["event_id", *schemas.EVENT_PARTITIONS]
    assert sorted(map(str, event_days(rows).select(*columns).collect())) == sorted(map(str, silver(rows, AS_OF).select(*columns).collect()))


def test_landed_rows_are_written_down_not_held(spark, monkeypatch):
    base, cars = tempfile.mkdtemp(prefix="run-"), [s["carChassis"] for s in scenarios()]
    lines = [json.dumps(event("a", cars[0])), "{broken", json.dumps(event("b", cars[1]))]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/landing")
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *a: pytest.fail("rows were held"))
    jobs.land_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/quarantine", f"{base}/audit", f"{base}/checkpoint", glob="*.txt", shape=landing.LINES)
    assert sorted(r.event_id for r in spark.read.schema(schemas.BRONZE).parquet(f"{base}/bronze").collect()) == ["a", "b"]
    assert [r.raw for r in spark.read.parquet(f"{base}/quarantine").collect()] == ["{broken"]
    (audit,) = spark.read.parquet(f"{base}/audit").collect()
    assert (audit.rows_loaded, audit.rows_rejected, audit.status) == (2, 1, "partial")
    assert files.folder_names(spark, f"{base}/checkpoint_parsed") == []
