"""Business rules as data: conditions over several columns and reference tables, compiled into one reject column and one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

ERROR, WARNING = "error", "warning"


@dataclass(frozen=True)
class Rule:
    """``holds`` is an SQL condition over the row, and over the columns of references by ``name.column``. It is checked where ``applies`` does.

    A condition that is NULL, for want of a value, counts as held unless ``nulls_break``. Broken errors reject the row, warnings are counted.
    """

    name: str
    holds: str
    applies: str = "true"
    severity: str = ERROR
    nulls_break: bool = False


@dataclass(frozen=True)
class Reference:
    """A table a row refers to: ``keys`` maps its key columns to columns of the row. ``take`` names columns for conditions.

    ``name.found`` says in a condition whether there is such a row. Of several rows with one key any one is taken; a key that is NULL finds none.
    """

    name: str
    table: DataFrame
    keys: dict[str, str]
    take: Sequence[str] = ()


def _joined(df: DataFrame, reference: Reference) -> DataFrame:
    """The row with a struct named after the reference. The reference is one row per key first, so no row is doubled and a hot key is one row."""
    keyed = reference.table.groupBy(*reference.keys).agg(*[F.any_value(c).alias(c) for c in reference.take], F.lit(True).alias("found"))
    renamed = keyed.select(*[F.col(k).alias(f"_{reference.name}_{k}") for k in reference.keys], F.struct("found", *reference.take).alias(reference.name))
    same = F.lit(True)
    for theirs, ours in reference.keys.items():
        same = same & (F.col(ours) == F.col(f"_{reference.name}_{theirs}"))
    joined = df.join(renamed, same, "left").drop(*[f"_{reference.name}_{k}" for k in reference.keys])
    return joined.withColumn(reference.name, F.struct(F.coalesce(F.col(f"{reference.name}.found"), F.lit(False)).alias("found"), *[F.col(f"{reference.name}.{c}") for c in reference.take]))


def _broken(rule: Rule) -> Column:
    holds = F.coalesce(F.expr(rule.holds), F.lit(not rule.nulls_break))
    return F.coalesce(F.expr(rule.applies), F.lit(False)) & ~holds


def checked(df: DataFrame, rules: Sequence[Rule], references: Sequence[Reference] = (), name: str = "broken_rules") -> DataFrame:
    """The rows with the names of the rules each breaks, in the rules' order, and ``rejected``: whether an error is among them."""
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("rules need names of their own")
    taken = {r.name for r in references} & set(df.columns)
    if taken:
        raise ValueError(f"references are named like columns: {sorted(taken)}")
    out = df
    for reference in references:
        out = _joined(out, reference)
    names = F.array_compact(F.array(*[F.when(_broken(r), r.name) for r in rules])) if rules else F.array().cast("array<string>")
    errors = F.array(*[F.lit(r.name) for r in rules if r.severity == ERROR]).cast("array<string>")
    out = out.withColumn(name, names).withColumn("rejected", F.arrays_overlap(name, errors))
    return out.drop(*[r.name for r in references])


def accepted(rows: DataFrame, name: str = "broken_rules") -> DataFrame:
    return rows.filter(~F.col("rejected")).drop(name, "rejected")


def report(rows: DataFrame, rules: Sequence[Rule], name: str = "broken_rules") -> DataFrame:
    """One row per rule, from one aggregate over all rows: its severity, how many rows break it, and their share."""
    counts = rows.agg(F.count("*").alias("rows"), *[F.count_if(F.array_contains(name, r.name)).alias(f"n{i}") for i, r in enumerate(rules)])
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"n{i}").alias("broken")) for i, r in enumerate(rules)])
    listed = counts.select("rows", F.inline(each))
    return listed.select("rule", "severity", "broken", "rows", F.round(F.try_divide(F.col("broken") * 100.0, F.col("rows")), 2).alias("broken_pct"))
