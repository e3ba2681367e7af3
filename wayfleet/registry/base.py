"""Named queries over the given tables, each with its ANSI SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfleet.session import pin
from wayfleet.sinks.files import PACKED

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; ``sql`` is omitted where SQL cannot express it."""

    def register(run: Run) -> Run:
        if name in RUNS:
            raise ValueError(f"query {name} is registered twice")

        def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(pin(spark), sf_dir)

        RUNS[name] = pinned
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settled(df: DataFrame, path: str) -> DataFrame:
    """Written once and read back: several steps start from it."""
    df.write.option("compression", PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rounded(expression: str, digits: int) -> str:
    """SQL for half-up rounding of a double as it prints, the way Spark rounds."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"
