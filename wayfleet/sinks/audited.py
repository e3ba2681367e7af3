"""Write, audit, publish: a version nobody reads until its checks have passed.

``root/data/version=N`` holds the rows. The audit reads them back and leaves its report in ``root/published/version=N`` or
``root/refused/version=N``; readers take the newest published one. Refused rows stay where they are, with
their report, until somebody drops them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wayfleet.operators.latest import duplicate_keys
from wayfleet.operators.quality import Checks, gate, quality_report
from wayfleet.schemas import empty
from wayfleet.sinks.files import remove, spread
from wayfleet.sinks.snapshots import folder, versions


def _at(root: str, part: str) -> str:
    return f"{root.rstrip('/')}/{part}"


def audit(rows: DataFrame, checks: Checks, keys: Sequence[str]) -> DataFrame:
    """One row: the quality report, how many keys occur more than once, and whether all of it passes."""
    report = quality_report(rows, checks)
    repeated = duplicate_keys(rows, keys).agg(F.count("*")).scalar()
    return report.withColumn("repeated_keys", repeated).withColumn("passed", F.col("is_valid") & (F.col("repeated_keys") == 0) & (F.col("record_count") > 0))


def publish_audited(df: DataFrame, root: str, checks: Checks, keys: Sequence[str], partitions: Sequence[str] = ()) -> bool:
    """Write ``df`` as a version, check what was written, and publish or refuse it; says which.

    A run that stops between the two leaves rows without a verdict, which no reader sees; ``finish_audits`` gives it. ``df`` may be
    worked out from the version that is current.
    """
    spark = df.sparkSession
    number = max(versions(spark, _at(root, "data"), complete_only=False), default=0) + 1
    writer = spread(df, partitions).write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(folder(_at(root, "data"), number))
    return _judge(spark, root, number, df.schema, checks, keys)


def _judge(spark: SparkSession, root: str, number: int, schema: T.StructType, checks: Checks, keys: Sequence[str]) -> bool:
    report = audit(spark.read.schema(schema).parquet(folder(_at(root, "data"), number)), checks, keys)
    draft = folder(_at(root, "reports"), number)
    report.coalesce(1).write.mode("overwrite").parquet(draft)
    done = spark.read.parquet(draft)
    passed = gate(done.withColumn("is_valid", F.col("passed")))
    # The verdict is the folder the report ends up in; its marker is written last.
    done.write.mode("overwrite").parquet(folder(_at(root, "published" if passed else "refused"), number))
    return passed


def finish_audits(spark: SparkSession, root: str, schema: T.StructType, checks: Checks, keys: Sequence[str]) -> list[int]:
    """Judge versions that were written whole but have no verdict; drop those not written whole. Gives the numbers judged."""
    known = {n for part in ("published", "refused") for n in versions(spark, _at(root, part))}
    whole = versions(spark, _at(root, "data"))
    for number in versions(spark, _at(root, "data"), complete_only=False):
        if number not in whole:
            remove(spark, folder(_at(root, "data"), number))
    open_ones = [n for n in whole if n not in known]
    for number in open_ones:
        _judge(spark, root, number, schema, checks, keys)
    return open_ones


def current(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest published version, or no rows."""
    known = versions(spark, _at(root, "published"))
    if not known:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(folder(_at(root, "data"), known[-1]))


def verdicts(spark: SparkSession, root: str) -> DataFrame:
    """The reports of all versions with their ``version`` and ``verdict``; none gives None."""
    found = None
    for verdict in ("published", "refused"):
        if versions(spark, _at(root, verdict)):
            rows = spark.read.parquet(_at(root, verdict)).withColumn("verdict", F.lit(verdict))
            rows = rows.withColumn("version", F.col("version").cast("int"))
            found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found


def drop_refused(spark: SparkSession, root: str, keep: int = 10) -> None:
    """Drop the rows of all but the newest ``keep`` refused versions; their reports stay."""
    for number in versions(spark, _at(root, "refused"))[:-keep]:
        remove(spark, folder(_at(root, "data"), number))
