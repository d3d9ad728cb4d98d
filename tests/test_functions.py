import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from pluvio.functions import calendar as cal, climate, values


def column(spark, kind, inputs, build):
    """The results of a column function over the inputs, in order."""
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_rounding_is_half_away_from_zero(spark):
    got = column(spark, "double", [0.125, -0.125, 2.675, 1.005, None], lambda v: values.rounded(v, 2))
    assert got == [0.13, -0.13, 2.68, 1.01, None]


def test_rain_classes_at_their_bounds(spark):
    got = column(spark, "double", [0.0, 0.1, 4.9, 5.0, 19.9, 20.0, 49.9, 50.0, None], climate.precipitation_class)
    assert got == ["dry", "light", "light", "moderate", "moderate", "heavy", "heavy", "extreme", "extreme"]


def test_null_class_lets_nulls_through(spark):
    assert column(spark, "double", [None, 1.0], lambda v: climate.precipitation_class(v, None)) == [None, "light"]
    assert column(spark, "double", [None, 1.0], lambda v: climate.uv_risk(v, None)) == [None, "low"]
    assert column(spark, "int", [None, 0], lambda v: climate.wmo_label(v, None)) == [None, "Clear sky"]
    assert column(spark, "double", [None, 0.0], lambda v: climate.beaufort(v, None)) == [None, 0]


def test_uv_levels_at_their_bounds(spark):
    got = column(spark, "double", [2.9, 3.0, 6.0, 8.0, 10.9, 11.0, None], climate.uv_risk)
    assert got == ["low", "moderate", "high", "very_high", "very_high", "extreme", "extreme"]


def test_beaufort_forces(spark):
    speeds = [0.9, 1.0, 5.9, 6.0, 12.0, 20.0, 29.0, 39.0, 50.0, 62.0, 75.0, 89.0, 103.0, 117.9, 118.0, None]
    assert column(spark, "double", speeds, climate.beaufort) == [0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11, 12, 12]


def test_wmo_labels(spark):
    got = column(spark, "int", [0, 48, 99, 4, None], climate.wmo_label)
    assert got == ["Clear sky", "Icy fog", "Thunderstorm with heavy hail", "Unknown", "Unknown"]
    assert len(climate.WMO_LABELS) == 24


def test_fahrenheit(spark):
    assert column(spark, "double", [0.0, 100.0, -40.0, 36.6, None], climate.c_to_f) == [32.0, 212.0, -40.0, 97.88, None]


ALERT_COLUMNS = ["temp_max_c", "temp_min_c", "precipitation_mm", "wind_speed_max_kmh", "uv_index_max",
                 "temp_anomaly_c", "precip_anomaly_mm"]
CALM = dict.fromkeys(ALERT_COLUMNS, 1.0)


@pytest.mark.parametrize(
    "reading, kind, grade",
    [
        ({}, None, "low"),
        (dict.fromkeys(ALERT_COLUMNS), None, "low"),
        ({"temp_max_c": 40.0}, None, "low"),
        ({"temp_max_c": 40.1}, "extreme_heat", "high"),
        ({"temp_max_c": 45.1}, "extreme_heat", "critical"),
        ({"temp_min_c": 0.0}, None, "low"),
        ({"temp_min_c": -0.1}, "frost", "low"),
        ({"temp_min_c": -0.1, "precipitation_mm": 200.0}, "frost", "critical"),
        ({"precipitation_mm": 80.1}, "heavy_rain", "high"),
        ({"wind_speed_max_kmh": 90.1}, "high_winds", "low"),
        ({"uv_index_max": 11.0}, "extreme_uv", "medium"),
        ({"temp_anomaly_c": 5.0}, None, "low"),
        ({"temp_anomaly_c": 5.01}, "heat_anomaly", "medium"),
        ({"temp_anomaly_c": -5.0}, None, "low"),
        ({"temp_anomaly_c": -5.01}, "cold_anomaly", "low"),
        ({"precip_anomaly_mm": 40.1}, "precip_anomaly", "low"),
        ({"temp_max_c": 41.0, "temp_min_c": -1.0, "precipitation_mm": 90.0}, "extreme_heat", "high"),
    ],
)
def test_alert_rules(spark, reading, kind, grade):
    values_ = {**CALM, **reading}
    df = spark.createDataFrame([tuple(values_[c] for c in ALERT_COLUMNS)], ", ".join(f"{c} double" for c in ALERT_COLUMNS))
    assert tuple(df.select(climate.alert_type(), climate.severity()).first()) == (kind, grade)


def test_thresholds_are_parameters(spark):
    from pluvio.config import Thresholds

    df = spark.createDataFrame([(1.0,) * 7], ", ".join(f"{c} double" for c in ALERT_COLUMNS))
    assert df.select(climate.alert_type(Thresholds(heat=0.5))).first()[0] == "extreme_heat"


def test_seasons_change_on_their_days(spark):
    days = ["2024-12-20", "2024-12-21", "2024-02-29", "2024-03-20", "2024-03-21", "2024-06-20", "2024-06-21",
            "2024-09-22", "2024-09-23"]
    got = column(spark, "string", days, lambda v: cal.season(v.cast("date")))
    assert got == ["Primavera", "Verão", "Verão", "Verão", "Outono", "Outono", "Inverno", "Inverno", "Primavera"]


def test_names_weekdays_and_quarters(spark):
    df = spark.createDataFrame([("2024-03-03",), ("2024-12-07",)], "d string").select(F.col("d").cast("date").alias("d"))
    d = F.col("d")
    got = df.select(cal.month_name_pt(d), cal.month_name_pt(d, short=True), cal.weekday_name_pt(d),
                    cal.weekday_name_pt(d, short=True), cal.dow(d), cal.is_weekend(d), *cal.quarter_labels(d)).collect()
    assert [tuple(r) for r in got] == [
        ("Março", "Mar", "Domingo", "Dom", 0, True, "1º Tri", "Q1"),
        ("Dezembro", "Dez", "Sábado", "Sáb", 6, True, "4º Tri", "Q4"),
    ]


def test_norm_ts(spark):
    got = column(spark, "string", ["2024-01-02T03:04", "2024-01-02T03:04:05", "2024-01-02", None], values.norm_ts)
    assert got == ["2024-01-02 03:04:00", "2024-01-02 03:04:05", "2024-01-02", None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    keys = [r[0] for r in df.select(values.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert keys == [hashlib.md5(text).hexdigest() for text in (b"a-b", b"a-_null_")]


def test_load_status(spark):
    now = dt.datetime(2024, 1, 10, 12)
    loads = [now - dt.timedelta(hours=25, minutes=59), now - dt.timedelta(hours=26), None]
    df = spark.createDataFrame(list(enumerate(loads)), "i int, t timestamp")
    age, status = values.load_status(F.col("t"), F.lit(now))
    assert [tuple(r) for r in df.orderBy("i").select(age, status).collect()] == [
        (25, "fresh"), (26, "stale"), (None, "never_loaded")]


def test_iso_text(spark):
    times = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60), None]
    assert column(spark, "timestamp", times, values.iso_text) == [
        "2024-01-02T03:04:05", "2024-01-02T03:04:05.000060", None]
