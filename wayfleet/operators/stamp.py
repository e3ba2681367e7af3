"""Processing metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stamp(df: DataFrame, *, timestamp: str | None = None, date: str | None = None,
          constants: dict[str, str] | None = None, at: Column | None = None) -> DataFrame:
    """Add the named processing timestamp / date columns and constant tags.

    ``at`` fixes the moment; by default it is the start of the query.
    """
    moment = F.current_timestamp() if at is None else at
    added: dict[str, Column] = {}
    if timestamp:
        added[timestamp] = moment
    if date:
        added[date] = F.to_date(moment)
    for name, value in (constants or {}).items():
        added[name] = F.lit(value)
    return df.withColumns(added)
