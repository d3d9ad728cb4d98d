"""Key filter, dedup and the two staging models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pluvio.functions.climate import temp_mean
from pluvio.schemas import RAW_HOURLY


def require(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("_extracted_at", "id")) -> DataFrame:
    """Newest row per key, nulls oldest.

    ``row_number = 1`` plans as a group limit that runs before the exchange too, so at most
    one row per key and map task is shuffled: a key repeated in a third of all rows is no hot spot.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def daily_columns() -> list[Column]:
    """Model names over the raw daily ones."""
    high, low = F.col("temperature_2m_max"), F.col("temperature_2m_min")
    return [
        F.col("location_id"),
        F.col("date"),
        F.col("latitude"),
        F.col("longitude"),
        high.alias("temp_max_c"),
        low.alias("temp_min_c"),
        temp_mean(high, low).alias("temp_avg_c"),
        F.col("precipitation_sum").alias("precipitation_mm"),
        F.col("rain_sum").alias("rain_mm"),
        F.col("wind_speed_10m_max").alias("wind_speed_max_kmh"),
        F.col("uv_index_max"),
        F.col("sunrise").alias("sunrise_at"),
        F.col("sunset").alias("sunset_at"),
        F.col("_extracted_at"),
        F.current_timestamp().alias("_loaded_at"),
    ]


def hottest(raw: DataFrame, column: str = "location_id") -> int:
    """How many rows the most frequent value has. One number comes back."""
    return raw.groupBy(column).agg(F.count(column).alias("n")).agg(F.max("n")).first()[0] or 0


def stg_daily(raw: DataFrame, by_location: bool = False) -> DataFrame:
    """Daily readings: required keys, newest extraction, model names.

    ``by_location`` brings the rows together by location alone, all repeats among them, so that what follows by location needs no
    exchange of its own: for raw tables in which no location is hot.
    """
    rows = require(raw, "location_id", "date")
    return dedup_latest(rows.repartition("location_id") if by_location else rows, ["location_id", "date"]).select(daily_columns())


# The model name of each hourly column that is renamed.
HOURLY_NAMES = {
    "timestamp": "observed_at",
    "elevation": "elevation_m",
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "relative_humidity_pct",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_speed_kmh",
    "wind_direction_10m": "wind_direction_deg",
    "surface_pressure": "surface_pressure_hpa",
    "cloud_cover": "cloud_cover_pct",
    "visibility": "visibility_m",
    "weather_code": "wmo_weather_code",
}


def hourly_columns() -> list[Column]:
    """Model names over the raw hourly ones."""
    kept = [f.name for f in RAW_HOURLY if f.name != "id"]
    return [*[F.col(c).alias(HOURLY_NAMES.get(c, c)) for c in kept], F.current_timestamp().alias("_loaded_at")]


def stg_hourly(raw: DataFrame) -> DataFrame:
    """Hourly readings: required keys, newest extraction, model names."""
    return dedup_latest(require(raw, "location_id", "timestamp"), ["location_id", "timestamp"]).select(hourly_columns())
