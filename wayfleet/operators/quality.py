"""Quality checks: one pass over the data, one row per dataset or per file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayfleet.operators.ordered import quantiles

# Weights and the score under which a dataset is refused.
START, ERROR_COST, WARNING_COST, PASS_MARK = 100, 20, 5, 70


@dataclass(frozen=True)
class Checks:
    """What a dataset has to satisfy. Names are matched without regard to case."""

    required: Sequence[str] = ("carchassis", "model", "year", "manufacturer")
    ranges: dict[str, tuple[float, float]] = field(default_factory=lambda: {"year": (1900, 2030)})
    unique: str | None = "carchassis"
    nested: Sequence[str] = ("metrics",)


def _find(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def _outside(column: str, bounds: tuple[float, float]) -> Column:
    return (F.col(column) < bounds[0]) | (F.col(column) > bounds[1])


def score_from(errors: Column, warnings: Column) -> Column:
    return F.greatest(F.lit(0), F.lit(START) - errors * ERROR_COST - warnings * WARNING_COST)


def quality_report(df: DataFrame, checks: Checks = Checks(), by: str | None = None) -> DataFrame:
    """Counts, score and verdict per value of ``by`` (a file name), or for all rows.

    A required column that is absent is an error; NULLs in it, values out of range,
    repeated keys and empty nested records are one warning each. Rows are first
    reduced per (group, key), so a key or file that dominates the data is summed
    on the map side and the duplicate count is exact.
    """
    present = {n: _find(df, n) for n in checks.required}
    missing = [n for n, found in present.items() if found is None]
    tests: dict[str, Column] = {
        f"null_{n.lower()}": F.col(found).isNull() for n, found in present.items() if found
    }
    for name, bounds in checks.ranges.items():
        found = _find(df, name)
        if found:
            tests[f"out_of_range_{name.lower()}"] = _outside(found, bounds)
    nested_ok: dict[str, Column] = {}
    for name in checks.nested:
        found = _find(df, name)
        if found:
            is_struct = isinstance(df.schema[found].dataType, T.StructType)
            nested_ok[f"nested_rows_{name.lower()}"] = F.col(found).isNotNull() & F.lit(is_struct)

    group = [by] if by else []
    key = _find(df, checks.unique) if checks.unique else None
    inner_keys = [F.col(g) for g in group] + ([F.col(key).alias("_key")] if key else [])
    counted = df.groupBy(*inner_keys).agg(
        F.count("*").alias("_rows"),
        *(F.count_if(c).alias(n) for n, c in {**tests, **nested_ok}.items()),
    )
    if not key:
        counted = counted.withColumn("_rows_beyond_first", F.lit(0).cast("bigint"))
    else:
        counted = counted.withColumn("_rows_beyond_first", F.col("_rows") - 1)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint"))

    per_group = counted.groupBy(*group).agg(
        total("_rows").alias("record_count"),
        total("_rows_beyond_first").alias("duplicate_count"),
        *(total(n).alias(n) for n in (*tests, *nested_ok)),
    )
    warnings = F.lit(0)
    for name in (*tests, "duplicate_count"):
        warnings = warnings + F.when(F.col(name) > 0, 1).otherwise(0)
    for name in nested_ok:
        warnings = warnings + F.when(F.col(name) == 0, 1).otherwise(0)
    scored = per_group.withColumns(
        {"error_count": F.lit(len(missing)), "warning_count": warnings}
    ).withColumn("quality_score", score_from(F.col("error_count"), F.col("warning_count")))
    return scored.withColumns(
        {
            "missing_columns": F.lit(",".join(missing)),
            "is_valid": (F.col("error_count") == 0) & (F.col("quality_score") >= PASS_MARK),
        }
    )


def gate(report: DataFrame) -> bool:
    """True when there is at least one dataset and every one of them is valid."""
    verdict = report.agg(F.count("*").alias("n"), F.coalesce(F.min("is_valid"), F.lit(False)).alias("ok")).first()
    return bool(verdict.n and verdict.ok)


def row_score(df: DataFrame, checks: Checks, name: str = "data_quality_score") -> DataFrame:
    """Score each row with the same rules: missing value 20 points, out of range 5."""
    errors, warnings = F.lit(0), F.lit(0)
    for wanted in checks.required:
        found = _find(df, wanted)
        errors = errors + (F.lit(1) if found is None else F.col(found).isNull().cast("int"))
    for wanted, bounds in checks.ranges.items():
        found = _find(df, wanted)
        if found:
            warnings = warnings + F.coalesce(_outside(found, bounds), F.lit(False)).cast("int")
    return df.withColumn(name, score_from(errors, warnings))


def unusual(df: DataFrame, measure: str, reach: float = 1.5) -> DataFrame:
    """Flag values further than ``reach`` interquartile ranges outside the exact quartiles."""
    found = quantiles(df, measure, {"low": 0.25, "high": 0.75})
    quartiles = found.select(F.struct("low", "high")).scalar()
    low, high = quartiles["low"], quartiles["high"]
    margin = (high - low) * reach
    flag = (F.col(measure) < low - margin) | (F.col(measure) > high + margin)
    return df.withColumn("is_outlier", F.coalesce(flag, F.lit(False)))


def fill_with_median(df: DataFrame, measure: str, by: str) -> DataFrame:
    """Replace missing values by the exact median of their group.

    Medians are joined back; Spark broadcasts them only if they turn out small, and splits a dominant group otherwise.
    """
    medians = quantiles(df, measure, {"_median": 0.5}, [by])
    joined = df.join(medians, by, "left")
    return joined.withColumn(measure, F.coalesce(F.col(measure), F.col("_median"))).drop("_median")
