"""An index from event ids to the days they are stored on.

Each load adds its ids in hash buckets and, for every bucket, a Bloom filter over them. A batch asks the filters first: most of its
ids are new, and for these nothing else is read. Only the buckets of loads that may hold one of its ids are opened. Loads
are never rewritten; ``merge_loads`` puts them into one from time to time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfleet.schemas import EVENT_PARTITIONS, empty, record
from wayfleet.sinks.files import remove, write_once
from wayfleet.sources.tables import folder_exists

BUCKETS = 64
# Bits for each id and hashes: 1 % of the ids that are not there pass.
BITS, HASHES = 10, 7

# What is found by an event's id.
DAYS = record(event_id="string", **{name: "string" for name in EVENT_PARTITIONS})
_FILTERS = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("load_id", T.StringType())])


def _entries(root: str) -> str:
    return f"{root.rstrip('/')}/entries"


def _filters(root: str) -> str:
    return f"{root.rstrip('/')}/filters"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _places(key: Column, n_bits: Column) -> list[Column]:
    """Where the bits of a key are: two hashes, the second taken one time more for each."""
    one, two = (F.pmod(F.xxhash64(key, F.lit(seed)), n_bits) for seed in (1, 2))
    return [F.pmod(one + two * i, n_bits) for i in range(HASHES)]


def bloom_filters(entries: DataFrame, key: str) -> DataFrame:
    """(bucket, words): a Bloom filter for every bucket, as 64-bit words; as many bits as the fullest bucket needs.

    Bits are set word by word in a grouped aggregation, whose rows are already combined in each task.
    """
    sized = entries.groupBy("bucket").agg(F.count("*").alias("_n"))
    n_words = sized.agg(F.ceil(F.max("_n") * BITS / 64)).scalar()
    rows = entries.select("bucket", F.explode(F.array(*_places(F.col(key), n_words * 64))).alias("_place"))
    set_bits = rows.groupBy("bucket", F.floor(F.col("_place") / 64).cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_place % 64 AS INT)))").alias("bits"))
    every = sized.select("bucket", F.explode(F.sequence(F.lit(0), (n_words - 1).cast("int"))).alias("word"), F.lit(0).cast("bigint").alias("bits"))
    dense = set_bits.unionByName(every).groupBy("bucket", "word").agg(F.expr("bit_or(bits)").alias("bits"))
    return dense.groupBy("bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))


def _may_hold(words: Column, key: Column) -> Column:
    found = F.lit(True)
    for place in _places(key, F.size(words).cast("bigint") * 64):
        word = F.get(words, F.floor(place / 64).cast("int"))
        found = found & (F.getbit(word, (place % 64).cast("int")) == 1)
    return found


def record_load(entries: DataFrame, root: str, load_id: str, key: str = "event_id", buckets: int = BUCKETS) -> None:
    """Add the entries (key and whatever is to be found by it) of one load. Repeating a load changes nothing.

    A load counts once its filters are there, which are written last.
    """
    spark = entries.sparkSession
    at = f"{_entries(root)}/load_id={load_id}"
    write_once(entries.withColumn("bucket", _bucket(key, buckets)), at, ["bucket"])
    stored = spark.read.schema(_with_bucket(entries.schema)).parquet(at)
    write_once(bloom_filters(stored, key), f"{_filters(root)}/load_id={load_id}")


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])


def loads(spark: SparkSession, root: str) -> DataFrame:
    """The Bloom filters of all complete loads: a few bytes for every ten ids."""
    if not folder_exists(spark, _filters(root)):
        return empty(spark, _FILTERS)
    return spark.read.schema(_FILTERS).parquet(_filters(root))


def candidates(ids: DataFrame, root: str, key: str = "event_id", buckets: int = BUCKETS) -> DataFrame:
    """(load_id, bucket, key): ids of a batch that a load's filter does not rule out. The ids of a bucket meet its filters as one row."""
    held = ids.select(key).distinct().groupBy(_bucket(key, buckets).alias("bucket")).agg(F.collect_list(key).alias("_ids"))
    asked = held.join(loads(ids.sparkSession, root), "bucket")
    passed = F.filter("_ids", lambda i: _may_hold(F.col("words"), i))
    return asked.select("load_id", "bucket", F.explode(passed).alias(key))


def lookup(ids: DataFrame, root: str, schema: T.StructType, key: str = "event_id", buckets: int = BUCKETS) -> DataFrame:
    """Entries of the given ids. Only folders (load, bucket) in which one of them may be are listed and read.

    The names of these folders come to the driver: at most ``buckets`` for every load not yet merged.
    """
    spark = ids.sparkSession
    if not folder_exists(spark, _filters(root)):
        return empty(spark, schema)
    asked = candidates(ids, root, key, buckets)
    opened = F.lit(False)
    for row in asked.groupBy("load_id").agg(F.array_sort(F.collect_set("bucket")).alias("of")).collect():
        opened = opened | ((F.col("load_id") == row["load_id"]) & F.col("bucket").isin(row["of"]))
    layout = T.StructType([*_with_bucket(schema).fields, T.StructField("load_id", T.StringType())])
    stored = spark.read.schema(layout).parquet(_entries(root)).filter(opened)
    return stored.join(ids.select(key).distinct(), key, "left_semi").select(*schema.names)


def merge_loads(spark: SparkSession, root: str, schema: T.StructType, load_id: str, key: str = "event_id", buckets: int = BUCKETS) -> int:
    """Put all loads into one named ``load_id`` and drop them; gives how many there were. Meanwhile both are read, to the same effect."""
    done = [r["load_id"] for r in loads(spark, root).select("load_id").distinct().collect()]
    old = [name for name in done if name != load_id]
    if load_id not in done and old:
        layout = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
        stored = spark.read.schema(layout).parquet(_entries(root)).filter(F.col("load_id").isin(old))
        record_load(stored.select(*schema.names).distinct(), root, load_id, key, buckets)
    for name in old:
        remove(spark, f"{_filters(root)}/load_id={name}")
        remove(spark, f"{_entries(root)}/load_id={name}")
    return len(old)
