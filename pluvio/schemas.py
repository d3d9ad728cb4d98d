"""Declared schemas. Sources are never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
_DATE, _TS = T.DateType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


DAILY_VARIABLES = _struct(
    ("temperature_2m_max", _D),
    ("temperature_2m_min", _D),
    ("precipitation_sum", _D),
    ("rain_sum", _D),
    ("wind_speed_10m_max", _D),
    ("sunrise", _TS),
    ("sunset", _TS),
    ("uv_index_max", _D),
)

HOURLY_VARIABLES = _struct(
    ("temperature_2m", _D),
    ("relative_humidity_2m", _I),
    ("precipitation", _D),
    ("wind_speed_10m", _D),
    ("wind_direction_10m", _I),
    ("surface_pressure", _D),
    ("cloud_cover", _I),
    ("visibility", _D),
    ("weather_code", _I),
)

RAW_DAILY = T.StructType(
    _struct(("id", _L), ("location_id", _S), ("date", _DATE), ("latitude", _D), ("longitude", _D)).fields
    + DAILY_VARIABLES.fields
    + _struct(("_extracted_at", _TS)).fields
)

RAW_HOURLY = T.StructType(
    _struct(
        ("id", _L), ("location_id", _S), ("timestamp", _TS), ("latitude", _D), ("longitude", _D),
        ("elevation", _D), ("timezone", _S),
    ).fields
    + HOURLY_VARIABLES.fields
    + _struct(("_extracted_at", _TS)).fields
)

# Fixed precisions of the relational raw tables.
DAILY_DECIMALS = {
    "latitude": (9, 6), "longitude": (9, 6), "temperature_2m_max": (5, 2), "temperature_2m_min": (5, 2),
    "precipitation_sum": (7, 2), "rain_sum": (7, 2), "wind_speed_10m_max": (5, 2), "uv_index_max": (4, 2),
}
HOURLY_DECIMALS = {
    "latitude": (9, 6), "longitude": (9, 6), "elevation": (7, 2), "temperature_2m": (5, 2),
    "precipitation": (6, 2), "wind_speed_10m": (5, 2), "surface_pressure": (7, 2), "visibility": (8, 2),
}


def with_decimals(schema: T.StructType, decimals: dict[str, tuple[int, int]]) -> T.StructType:
    """The same schema with the relational precision on its numeric columns."""
    return T.StructType(
        [T.StructField(f.name, T.DecimalType(*decimals[f.name]) if f.name in decimals else f.dataType) for f in schema]
    )


LOCATIONS = _struct(
    ("location_id", _S), ("city_name", _S), ("state_name", _S), ("state_code", _S), ("country", _S), ("region", _S),
    ("mesoregion", _S), ("latitude", _D), ("longitude", _D), ("altitude_m", _D), ("population_class", _S),
)

DAILY_FACTS = _struct(
    ("surrogate_key", _S), ("date", _DATE), ("year", _I), ("month", _I), ("day", _I), ("year_month", _S),
    ("day_of_week", _I), ("is_weekend", T.BooleanType()), ("quarter", _I),
    ("location_id", _S), ("city_name", _S), ("state_name", _S), ("country", _S), ("region", _S), ("mesoregion", _S),
    ("latitude", _D), ("longitude", _D), ("altitude_m", _D),
    ("temp_max_c", _D), ("temp_min_c", _D), ("temp_avg_c", _D), ("temp_amplitude_c", _D), ("temp_anomaly_c", _D),
    ("temp_avg_30d_c", _D),
    ("precipitation_mm", _D), ("rain_mm", _D), ("precip_avg_30d_mm", _D), ("precip_anomaly_mm", _D),
    ("precipitation_class", _S),
    ("wind_speed_max_kmh", _D), ("uv_index_max", _D), ("uv_risk_level", _S),
    ("sunrise_at", _TS), ("sunset_at", _TS), ("daylight_hours", _D),
    ("_extracted_at", _TS), ("_loaded_at", _TS), ("_dbt_updated_at", _TS),
)

HOURLY_FACTS = _struct(
    ("surrogate_key", _S), ("observed_at", _TS), ("date", _DATE), ("hour", _I), ("year", _I), ("month", _I),
    ("year_month", _S),
    ("location_id", _S), ("city_name", _S), ("state_name", _S), ("region", _S), ("mesoregion", _S),
    ("latitude", _D), ("longitude", _D),
    ("temperature_c", _D), ("relative_humidity_pct", _I), ("precipitation_mm", _D), ("wind_speed_kmh", _D),
    ("wind_direction_deg", _I), ("surface_pressure_hpa", _D), ("cloud_cover_pct", _I), ("visibility_m", _D),
    ("wmo_weather_code", _I), ("wmo_weather_label", _S),
    ("_extracted_at", _TS), ("_loaded_at", _TS), ("_dbt_updated_at", _TS),
)

ALERTS = _struct(
    ("surrogate_key", _S), ("date", _DATE), ("year_month", _S), ("location_id", _S), ("city_name", _S),
    ("state_name", _S), ("region", _S), ("mesoregion", _S), ("alert_type", _S), ("severity", _S),
    ("temp_max_c", _D), ("temp_min_c", _D), ("temp_anomaly_c", _D), ("precipitation_mm", _D),
    ("wind_speed_max_kmh", _D), ("uv_index_max", _D), ("_dbt_updated_at", _TS),
)

# Which hours the hourly mart holds: one row per location, city and date.
HOURLY_COVERAGE = _struct(("location_id", _S), ("city_name", _S), ("date", _DATE), ("hours", T.LongType()))
STORED_COVERAGE = T.StructType([*HOURLY_COVERAGE.fields, *_struct(("year_month", _S)).fields])

_READING = _struct(("date", _DATE), ("temp_max_c", _D), ("temp_avg_c", _D), ("precipitation_mm", _D))

# The last readings of a location before the month ``before``: how many, the oldest one's date, those of the month just before in order, and the last one if it lies earlier.
WINDOW_STATE = _struct(
    ("location_id", _S), ("n", _I), ("first", _DATE), ("readings", T.ArrayType(_READING)), ("last", _READING), ("before", _S),
)

# The newest reading of each location.
LATEST_READINGS = _struct(
    ("location_id", _S), ("city_name", _S), ("mesoregion", _S), ("latitude", _D), ("longitude", _D), ("date", _DATE),
    ("temp_max_c", _D), ("precipitation_mm", _D),
)

# What a folder of a checked table (and one of its locations, where that is needed) came to: failures by check (checks without any are left out).
FOLDER_SUMMARY = _struct(
    ("folder", _S), ("version", _S), ("location_id", _S), ("total", _L), ("misplaced", _L), ("repeated", _L), ("first", _DATE), ("last", _DATE),
    ("_extracted_at", _TS), ("failures", T.MapType(_S, _L)),
)
