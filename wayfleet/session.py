"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results, not speed.  Timestamps in the feeds are UTC
# instants spelled with a literal Z, and partition values such as '04' must stay
# strings when a table is read back.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# HotSpot does not compile methods above 8000 bytecodes. Projections as wide as the
# telemetry layout exceed that when fused into one generated method and would then run
# interpreted, two to four times slower; above this limit Spark splits them instead.
WIDE_ROW_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Sensible defaults for a large cluster; everything here can be overridden.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name: str = "wayfleet", master: str | None = None, **overrides: str) -> SparkSession:
    """Create (or fetch) a session carrying the settings above.

    ``overrides`` use ``__`` for the dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = {**CLUSTER_SETTINGS, **WIDE_ROW_SETTINGS, **RESULT_SETTINGS}
    merged.update({k.replace("__", "."): v for k, v in overrides.items()})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings this package relies on to a session somebody else built."""
    for key, value in {**RESULT_SETTINGS, **WIDE_ROW_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only when that setting is absent and everything runs in one process (unit tests, a laptop)
    is a local folder made, and it is then remembered for the rest of the session. On a
    cluster a machine's own folder would be seen by that machine alone, so the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wayfleet-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/wayfleet/{label}-{uuid.uuid4().hex[:12]}"
