"""Calendar columns and the single notion of "today"."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

AsOf = dt.date | str | None


def today(as_of: AsOf = None) -> Column:
    """``as_of`` as a date column; the run date when nothing is given.

    Both forms fold to a literal before planning, so they can prune partitions.
    """
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def date_parts(ts: Column, prefix: str) -> dict[str, Column]:
    """Zero-padded year, month and day strings named ``<prefix>_year`` and so on."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd"}
    return {f"{prefix}_{part}": F.date_format(ts, pattern) for part, pattern in patterns.items()}


def event_time_or(df: DataFrame, name: str, fallback: Column) -> Column:
    """The event-time column when the frame has one, else ``fallback``.

    Decided from the schema. A NULL inside an existing column stays NULL: such
    rows belong in quarantine, not in today's partition.
    """
    return F.col(name) if name in df.columns else fallback


def in_current_month(as_of: AsOf = None, year: str = "event_year", month: str = "event_month") -> Column:
    """Partition predicate: the calendar month that contains ``as_of``."""
    now = today(as_of)
    return (F.col(year) == F.date_format(now, "yyyy")) & (F.col(month) == F.date_format(now, "MM"))


def in_recent_years(as_of: AsOf = None, years: int = 1, year: str = "event_year") -> Column:
    """Partition predicate: this calendar year and the ``years - 1`` before it."""
    now = today(as_of)
    wanted = [(F.year(now) - back).cast("string") for back in range(years)]
    return F.col(year).isin(*wanted)


def on_day(year: str, month: str | None = None, day: str | None = None,
           columns: Sequence[str] = ("event_year", "event_month", "event_day")) -> Column:
    """Partition predicate for one year, month or day given as strings."""
    wanted = [(c, v) for c, v in zip(columns, (year, month, day)) if v is not None]
    condition = F.lit(True)
    for name, value in wanted:
        condition = condition & (F.col(name) == F.lit(value))
    return condition


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours from ``start`` to ``end``."""
    return F.timestamp_diff("HOUR", start, end)
