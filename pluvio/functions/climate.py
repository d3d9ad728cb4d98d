"""Classifiers and derived measures of readings.

A null reading falls into the class named by ``null_class``; pass ``None`` to let nulls through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.functions import lit

from pluvio.config import Thresholds
from pluvio.functions.values import rounded

# WMO weather codes and their labels.
WMO_LABELS = {
    0: "Clear sky", 1: "Mainly clear", 2: "Partly cloudy", 3: "Overcast",
    45: "Fog", 48: "Icy fog",
    51: "Light drizzle", 53: "Moderate drizzle", 55: "Dense drizzle",
    61: "Slight rain", 63: "Moderate rain", 65: "Heavy rain",
    71: "Slight snow", 73: "Moderate snow", 75: "Heavy snow", 77: "Snow grains",
    80: "Slight showers", 81: "Moderate showers", 82: "Violent showers",
    85: "Slight snow showers", 86: "Heavy snow showers",
    95: "Thunderstorm", 96: "Thunderstorm with hail", 99: "Thunderstorm with heavy hail",
}
# Upper bounds (exclusive, km/h) of Beaufort forces 0 to 11; 12 lies above.
BEAUFORT_BOUNDS = [1, 6, 12, 20, 29, 39, 50, 62, 75, 89, 103, 118]
# Classes by upper bound (exclusive), with the class above the last bound.
RAIN_CLASSES = [(5, "light"), (20, "moderate"), (50, "heavy")]
UV_CLASSES = [(3, "low"), (6, "moderate"), (8, "high"), (11, "very_high")]
TOP_CLASS = "extreme"


def _below(value: Column, bounds: Sequence[tuple[float, object]], above: object, null_class: object, *first) -> Column:
    label = F.when(value.isNull(), lit(null_class))
    for condition, name in first:
        label = label.when(condition, name)
    for bound, name in bounds:
        label = label.when(value < bound, name)
    return label.otherwise(above)


def precipitation_class(mm: Column, null_class: str | None = TOP_CLASS) -> Column:
    return _below(mm, RAIN_CLASSES, TOP_CLASS, null_class, (mm == 0, "dry"))


def uv_risk(index: Column, null_class: str | None = TOP_CLASS) -> Column:
    return _below(index, UV_CLASSES, TOP_CLASS, null_class)


def beaufort(kmh: Column, null_class: int | None = 12) -> Column:
    return _below(kmh, [(bound, force) for force, bound in enumerate(BEAUFORT_BOUNDS)], 12, null_class).cast("int")


def wmo_label(code: Column, null_class: str | None = "Unknown") -> Column:
    labels = F.create_map(*[lit(x) for pair in WMO_LABELS.items() for x in pair])
    known = F.coalesce(F.try_element_at(labels, code), lit("Unknown"))
    return F.when(code.isNull(), lit(null_class)).otherwise(known)


def temp_mean(high: Column, low: Column) -> Column:
    return (high + low) / 2


def temp_amplitude(high: Column, low: Column) -> Column:
    return rounded(high - low, 2)


def anomaly(value: Column, mean: Column) -> Column:
    return rounded(value - mean, 2)


def daylight_hours(sunrise: Column, sunset: Column) -> Column:
    return F.timestamp_diff("SECOND", sunrise, sunset) / 3600


def c_to_f(celsius: Column) -> Column:
    return rounded(celsius * 9 / 5 + 32, 2)


def alert_type(t: Thresholds = Thresholds()) -> Column:
    """First rule that holds, over the columns of the daily facts; null when none does."""
    rules = [
        (F.col("temp_max_c") > t.heat, "extreme_heat"),
        (F.col("temp_min_c") < t.frost, "frost"),
        (F.col("precipitation_mm") > t.rain, "heavy_rain"),
        (F.col("wind_speed_max_kmh") > t.wind, "high_winds"),
        (F.col("uv_index_max") >= t.uv, "extreme_uv"),
        (F.col("temp_anomaly_c") > t.temp_anomaly, "heat_anomaly"),
        (F.col("temp_anomaly_c") < -t.temp_anomaly, "cold_anomaly"),
        (F.col("precip_anomaly_mm") > t.rain_anomaly, "precip_anomaly"),
    ]
    return F.coalesce(*[F.when(holds, name) for holds, name in rules])


def severity(t: Thresholds = Thresholds()) -> Column:
    """Graded apart from the alert type: frost and wind alone stay ``low``."""
    heat, rain = F.col("temp_max_c"), F.col("precipitation_mm")
    return (
        F.when((heat > t.critical_heat) | (rain > t.critical_rain), "critical")
        .when((heat > t.heat) | (rain > t.rain), "high")
        .when((F.col("temp_anomaly_c") > t.temp_anomaly) | (F.col("uv_index_max") >= t.uv), "medium")
        .otherwise("low")
    )
