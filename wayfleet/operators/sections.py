"""Reports made of unlike sections stacked on one set of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def section(df: DataFrame, label: str, layout: Mapping[str, str], values: Mapping[str, Column],
            label_name: str = "report_section") -> DataFrame:
    """Project onto ``layout`` (column -> type); columns without a value are typed NULLs."""
    unknown = set(values) - set(layout)
    if unknown:
        raise ValueError(f"not in the report layout: {sorted(unknown)}")
    columns = [F.lit(label).alias(label_name)]
    for name, dtype in layout.items():
        columns.append(values.get(name, F.lit(None)).cast(dtype).alias(name))
    return df.select(*columns)


def stack(sections: Sequence[DataFrame]) -> DataFrame:
    result = sections[0]
    for following in sections[1:]:
        result = result.unionByName(following)
    return result


def custom_order(column: Column, ranking: Sequence[str]) -> Column:
    """Position of a label in ``ranking``; anything else sorts after it."""
    return F.coalesce(
        *(F.when(column == label, F.lit(i)) for i, label in enumerate(ranking, start=1)),
        F.lit(len(ranking) + 1),
    )
