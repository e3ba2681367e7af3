"""Distributions, shares, rates and totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def distribution(df: DataFrame, by: Sequence[str], count_name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(count_name))


def with_share(counted: DataFrame, count_name: str, share_name: str = "percentage",
               digits: int | None = 2) -> DataFrame:
    """Each row's part of the overall count, in percent.

    The total comes from a one-row subquery: a window over everything would pull
    all groups into one task.
    """
    total = counted.agg(F.sum(count_name)).scalar()
    share = F.try_divide(F.col(count_name) * F.lit(100.0), total)
    return counted.withColumn(share_name, share if digits is None else F.round(share, digits))


def pct_of_rows(condition: Column) -> Column:
    """Percentage of rows in the group for which ``condition`` is true."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count("*"))


def pct_in_range(measure: str, low: float, high: float) -> Column:
    """Percentage of rows whose measure is in range; a missing measure is not."""
    return F.avg(F.when(F.col(measure).between(low, high), 1.0).otherwise(0.0)) * 100


def overall(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row of named aggregates over the whole frame."""
    return df.agg(*(c.alias(name) for name, c in measures.items()))


def violation_rate(df: DataFrame, broken: Column) -> DataFrame:
    """Rows, rows breaking a rule, and their rate, in a single pass."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(broken).alias("alert_rows"),
        F.round(pct_of_rows(broken), 2).alias("violation_rate_pct"),
    )


def with_group_count(df: DataFrame, name: str) -> DataFrame:
    """Stamp the number of rows of ``df`` on every row (fleet size on a snapshot)."""
    return df.withColumn(name, df.agg(F.count("*")).scalar())


def daily(df: DataFrame, ts: str, measures: Mapping[str, Column], name: str = "event_date") -> DataFrame:
    """Aggregates per calendar day of a timestamp."""
    return df.groupBy(F.to_date(ts).alias(name)).agg(*(c.alias(n) for n, c in measures.items()))
