"""Alert rules as data, compiled to native Column expressions.

A rule names a measure (any SQL expression over the row), the side of the bound
that fires, and a label. The order of a rule list is its priority.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    label: str
    measure: str
    bound: float
    fires: str = "above"
    severity: str = "HIGH"

    def value(self) -> Column:
        return F.expr(self.measure).cast("double")

    def fired(self) -> Column:
        measured = F.expr(self.measure)
        return measured > self.bound if self.fires == "above" else measured < self.bound


_TIRES = (
    "least(tire_pressure_front_left_psi, tire_pressure_front_right_psi, "
    "tire_pressure_rear_left_psi, tire_pressure_rear_right_psi)"
)
_FUEL_PERCENT = "try_divide(fuel_available_liters, fuel_capacity_liters) * 100"

# Labels and bounds of the rule sets in use.
SLIM_RULES = (
    Rule("OVERHEAT_ENGINE", "engine_temp_celsius", 100),
    Rule("OVERHEAT_OIL", "oil_temp_celsius", 110),
    Rule("SPEEDING_ALERT", "trip_max_speed_kmh", 110),
)
LEGACY_RULES = (
    Rule("OVERHEAT_ENGINE", "metrics_engineTempCelsius", 100),
    Rule("OVERHEAT_OIL", "metrics_oilTempCelsius", 110),
    Rule("SPEEDING_ALERT", "metrics_trip_tripMaxSpeedKm", 120),
)
SCENARIO_RULES = (
    Rule("OVERHEAT_ENGINE", "engine_temp_celsius", 100),
    Rule("OVERHEAT_OIL", "oil_temp_celsius", 115),
    Rule("LOW_TIRE_PRESSURE", _TIRES, 30, "below"),
    Rule("LOW_BATTERY", "battery_charge_percentage", 70, "below"),
    Rule("LOW_FUEL", _FUEL_PERCENT, 20, "below"),
)
SEVERITY_RULES = (
    Rule("ALTA_TEMPERATURA_MOTOR", "engine_temp_celsius", 100),
    Rule("ALTA_TEMPERATURA_OLEO", "oil_temp_celsius", 120),
    Rule("EXCESSO_VELOCIDADE", "trip_max_speed_kmh", 120),
)
MAINTENANCE_RULES = (
    Rule("OIL_CRITICAL", "oil_life_percentage", 20, "below", "CRITICAL"),
    Rule("OIL_LOW", "CASE WHEN oil_life_percentage >= 20 THEN oil_life_percentage END", 50, "below", "LOW"),
    Rule("ENGINE_TEMP", "engine_temp_celsius", 100, "above", "CRITICAL"),
    Rule("TIRE_PRESSURE", _TIRES, 30, "below", "LOW"),
    Rule("INSURANCE_EXPIRED", "insurance_days_expired", 0, "above", "CRITICAL"),
)


def any_fired(rules: Sequence[Rule]) -> Column:
    """Plain disjunction over the measures, so it reaches the Parquet scan."""
    condition = rules[0].fired()
    for rule in rules[1:]:
        condition = condition | rule.fired()
    return condition


def first_label(rules: Sequence[Rule], otherwise: str = "UNKNOWN") -> Column:
    return F.coalesce(*(F.when(r.fired(), F.lit(r.label)) for r in rules), F.lit(otherwise))


def first_value(rules: Sequence[Rule]) -> Column:
    return F.coalesce(*(F.when(r.fired(), r.value()) for r in rules))


def one_alert_per_row(df: DataFrame, rules: Sequence[Rule] = SLIM_RULES) -> DataFrame:
    """Rows that break a rule, labelled with the most important one."""
    return df.filter(any_fired(rules)).withColumns(
        {"alert_type": first_label(rules), "alert_value": first_value(rules)}
    )


def every_alert(df: DataFrame, rules: Sequence[Rule] = SCENARIO_RULES) -> DataFrame:
    """One row per broken rule. Map-only: the filter runs before the explode."""
    candidates = F.array(
        *(
            F.when(
                r.fired(),
                F.struct(
                    F.lit(r.label).alias("alert_type"),
                    r.value().alias("alert_value"),
                    F.lit(r.severity).alias("alert_status"),
                ),
            )
            for r in rules
        )
    )
    kept = df.columns
    return (
        df.filter(any_fired(rules))
        .withColumn("_alert", F.explode(F.array_compact(candidates)))
        .select(*(f"`{c}`" for c in kept), "_alert.*")
    )
