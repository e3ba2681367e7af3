"""Lenient typing: anything that does not parse becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# The textual forms used by the feeds.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY_MONTH_TIME = "dd MMM yyyy HH:mm:ss"
ISO_DATE = "yyyy-MM-dd"

# Columns of the first-generation layout that must be numeric.
LEGACY_NUMERIC = (
    "year", "ModelYear", "horsePower", "currentMileage", "fuelCapacityLiters",
    "metrics_engineTempCelsius", "metrics_oilTempCelsius", "metrics_batteryChargePerc",
    "metrics_fuelAvailableLiters", "metrics_coolantCelsius",
    "metrics_trip_tripMileage", "metrics_trip_tripTimeMinutes", "metrics_trip_tripFuelLiters",
    "metrics_trip_tripMaxSpeedKm", "metrics_trip_tripAverageSpeedKm",
    "market_currentPrice", "market_warrantyYears",
)


def iso_timestamp(c: Column) -> Column:
    """``2025-11-06T17:30:10Z``; fractional seconds do not match and give NULL."""
    return F.try_to_timestamp(c, F.lit(ISO_UTC))


def weekday_timestamp(c: Column) -> Column:
    """``Wed, 29 Oct 2025 11:00:00``.

    The weekday carries no information, so it is cut off instead of switching the
    whole session to the legacy parser.
    """
    has_weekday = c.rlike("^[A-Za-z]{3}, ")
    return F.when(has_weekday, F.try_to_timestamp(F.substr(c, F.lit(6)), F.lit(DAY_MONTH_TIME)))


def iso_date(c: Column) -> Column:
    return F.try_to_date(c, ISO_DATE)


def numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn the listed columns that exist into doubles."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present})
