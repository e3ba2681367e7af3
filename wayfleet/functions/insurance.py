"""Insurance classification. ``until`` and ``now`` are date columns.

A missing expiry date counts as active in both classifiers; the quality report
counts those rows so that they are not overlooked.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Status labels.
EXPIRED = "VENCIDO"
EXPIRING = "VENCENDO_EM_90_DIAS"
ACTIVE = "ATIVO"
HIGH_RISK, MEDIUM_RISK, LOW_RISK = "ALTO_RISCO", "MEDIO_RISCO", "BAIXO_RISCO"
EXPIRING_WITHIN_DAYS = 90


def days_left(until: Column, now: Column) -> Column:
    """Days until expiry, negative once expired."""
    return F.date_diff(until, now)


def two_way_status(until: Column, now: Column) -> Column:
    return F.when(until < now, F.lit(EXPIRED)).otherwise(F.lit(ACTIVE))


def three_way_status(until: Column, now: Column, window: int = EXPIRING_WITHIN_DAYS) -> Column:
    left = days_left(until, now)
    soon = left.between(0, window)
    return F.coalesce(F.when(left < 0, F.lit(EXPIRED)), F.when(soon, F.lit(EXPIRING)), F.lit(ACTIVE))


def overdue_days(until: Column, now: Column, otherwise: int | None = None) -> Column:
    """Days since expiry; ``otherwise`` (0 or NULL) for policies still in force."""
    return F.when(until < now, F.date_diff(now, until)).otherwise(F.lit(otherwise).cast("int"))


def risk_category(status: Column) -> Column:
    return (
        F.when(status == EXPIRED, F.lit(HIGH_RISK))
        .when(status == EXPIRING, F.lit(MEDIUM_RISK))
        .otherwise(F.lit(LOW_RISK))
    )
