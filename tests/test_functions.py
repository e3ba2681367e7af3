import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfleet.functions import alerts, clock, insurance, parsing, ratios, status, text

DAY = dt.date(2025, 11, 6)


def column(spark, values, dtype, *expressions):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [tuple(r) for r in df.select(*expressions).collect()]


def test_insurance_bounds(spark):
    day = DAY
    dates = [day - dt.timedelta(1), day, day + dt.timedelta(90), day + dt.timedelta(91), None]
    v, now = F.col("v"), F.lit(DAY)
    rows = column(spark, dates, "date", insurance.two_way_status(v, now), insurance.three_way_status(v, now),
                  insurance.overdue_days(v, now, 0), insurance.overdue_days(v, now), insurance.days_left(v, now))
    assert rows == [
        ("VENCIDO", "VENCIDO", 1, 1, -1),
        ("ATIVO", "VENCENDO_EM_90_DIAS", 0, None, 0),
        ("ATIVO", "VENCENDO_EM_90_DIAS", 0, None, 90),
        ("ATIVO", "ATIVO", 0, None, 91),
        ("ATIVO", "ATIVO", 0, None, None),
    ]


def test_ratios_survive_zero(spark):
    zero, one = F.lit(0.0), F.lit(1.0)
    row = spark.range(1).select(
        ratios.litres_per_100km(one, zero).alias("a"), ratios.average_speed(one, F.lit(0)).alias("b"),
        ratios.km_per_litre(one, zero).alias("c"), ratios.km_per_litre(one, zero, empty=0.0).alias("d"),
        ratios.km_per_litre(one, F.lit(None).cast("double"), empty=0.0).alias("e"),
        ratios.fill_level(one, F.lit(0)).alias("f"),
        ratios.litres_per_100km(F.lit(3.2), F.lit(31.5)).alias("g"),
        ratios.average_speed(F.lit(31.5), F.lit(45)).alias("h"),
        ratios.mean_of([one, one, one, F.lit(None).cast("double")]).alias("i"),
    ).first()
    assert tuple(row) == (None, None, None, 0.0, 0.0, None, 10.16, 42.0, None)


def test_ladders(spark):
    v = F.col("v")
    rows = column(spark, [19.9, 20.0, 49.9, 50.0, None], "double", status.below(v, status.OIL_BELOW))
    assert [r[0] for r in rows] == ["CRITICAL", "LOW", "LOW", "OK", "OK"]
    rows = column(spark, [95.0, 95.1, 100.0, 100.1, None], "double",
                  status.above(v, status.ENGINE_TEMP_ABOVE, "NORMAL"))
    assert [r[0] for r in rows] == ["NORMAL", "HIGH", "HIGH", "OVERHEATING", "NORMAL"]
    ratio = spark.range(1).select(status.below(ratios.fill_ratio(F.lit(12.3), F.lit(41)), status.FUEL_RATIO_BELOW))
    assert ratio.first()[0] == "OK"  # 0.30000000000000004 is not below 0.30


def test_attention_ignores_unknown(spark):
    unknown = F.lit(None).cast("boolean")
    row = spark.range(1).select(
        status.attention(unknown, F.lit(False)).alias("a"), status.attention(unknown, F.lit(True)).alias("b")).first()
    assert tuple(row) == ("OPERATIONAL", "ATTENTION_REQUIRED")


def test_parsing(spark):
    rows = column(spark, ["2025-11-06T17:30:10Z", "2025-11-06T17:30:10.5Z", "x", None], "string",
                  parsing.iso_timestamp(F.col("v")).cast("string"))
    assert [r[0] for r in rows] == ["2025-11-06 17:30:10", None, None, None]
    rows = column(spark, ["Wed, 29 Oct 2025 11:00:00", "29 Oct 2025 11:00:00", "Wed, soon"], "string",
                  parsing.weekday_timestamp(F.col("v")).cast("string"))
    assert [r[0] for r in rows] == ["2025-10-29 11:00:00", None, None]
    rows = column(spark, ["2025-10-29", "2025-13-01", ""], "string", parsing.iso_date(F.col("v")).cast("string"))
    assert [r[0] for r in rows] == ["2025-10-29", None, None]


def test_text(spark):
    rows = column(spark, ["mercedes-benz o'neil", None], "string", text.title_case(F.col("v")),
                  text.title_case(F.col("v"), every_break=True))
    assert rows == [("Mercedes-benz O'neil", "Mercedes-Benz O'Neil"), (None, None)]
    df = spark.createDataFrame([("  hyundai\t", " BLUE ", 1), (None, None, 2)], "Manufacturer string, color string, n int")
    tidied = text.tidy(df, title=["manufacturer"], lower=["color", "absent"], trim=True).collect()
    assert [tuple(r) for r in tidied] == [("Hyundai", "blue", 1), (None, None, 2)]


def test_calendar(spark):
    df = spark.createDataFrame([("2025", "11"), ("2025", "04"), ("2024", "11"), ("2023", "01")],
                               "event_year string, event_month string")
    assert df.filter(clock.in_current_month("2025-11-06")).count() == 1
    assert df.filter(clock.in_recent_years(dt.date(2025, 1, 1), 2)).count() == 3
    assert df.filter(clock.on_day("2025", "04")).count() == 1
    ts = F.lit("2025-04-03 00:00:00").cast("timestamp")
    row = spark.range(1).select(*(c.alias(n) for n, c in clock.date_parts(ts, "event").items())).first()
    assert row.asDict() == {"event_year": "2025", "event_month": "04", "event_day": "03"}
    hours = spark.range(1).select(clock.hours_between(ts, F.lit("2025-04-04 01:30:00").cast("timestamp"))).first()[0]
    assert hours == 25
    frame = spark.createDataFrame([(None,)], "at timestamp")
    assert frame.select(clock.event_time_or(frame, "at", ts)).first()[0] is None
    assert frame.select(clock.event_time_or(frame, "missing", ts)).first()[0] is not None


@pytest.mark.parametrize("engine,oil,speed,expected", [
    (101, 120, 120, ("OVERHEAT_ENGINE", 101.0)),
    (100, 111, 120, ("OVERHEAT_OIL", 111.0)),
    (None, 110, 111, ("SPEEDING_ALERT", 111.0)),
    (100, 110, 110, None),
    (None, None, None, None),
])
def test_alert_priority(spark, engine, oil, speed, expected):
    df = spark.createDataFrame([(engine, oil, speed)],
                               "engine_temp_celsius int, oil_temp_celsius int, trip_max_speed_kmh int")
    found = alerts.one_alert_per_row(df).select("alert_type", "alert_value").collect()
    assert [tuple(r) for r in found] == ([expected] if expected else [])


def test_alert_filter_reaches_the_scan_and_stays_native(spark, tmp_path):
    spark.createDataFrame([(1, 2, 3)], "engine_temp_celsius int, oil_temp_celsius int, trip_max_speed_kmh int") \
        .write.parquet(str(tmp_path / "t"))
    for make in (alerts.one_alert_per_row, lambda d: alerts.every_alert(d, alerts.SLIM_RULES)):
        plan = make(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [Or(Or(GreaterThan(engine_temp_celsius,100)" in plan
        assert "Python" not in plan and "Exchange" not in plan
