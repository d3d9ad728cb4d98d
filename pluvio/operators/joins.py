"""Joins with the locations and calendar dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pluvio.config import BROADCAST_LIMIT_BYTES
from pluvio.functions.values import rounded, rounded_sum


def measured_bytes(df: DataFrame) -> int:
    """Size of a dimension: text as stored, 8 bytes for any other value. One aggregated row comes back."""

    def width(name: str, kind: str) -> Column:
        return F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8)

    row_width = sum((width(name, kind) for name, kind in df.dtypes), F.lit(0))
    return df.agg(F.sum(row_width.cast("long"))).first()[0] or 0


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it measures at most ``limit`` bytes.

    Beyond the limit the join is hinted to merge: it shuffles by key and the adaptive planner splits skewed keys.
    Without a hint Spark would go by the size as stored, where repeated values take next to nothing, and broadcast it after all.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df.hint("merge")


def with_geography(readings: DataFrame, loc: DataFrame, columns: list[str]) -> DataFrame:
    """Left join of the seed's columns; they replace the readings' own of the same name."""
    own = [c for c in readings.columns if c not in columns]
    return readings.select(own).join(loc.select("location_id", *columns), "location_id", "left")


def orphan_alerts(alerts: DataFrame, loc: DataFrame) -> DataFrame:
    """Alerts whose location is not in the seed."""
    ids = small_side(loc.select("location_id"))
    return alerts.select("location_id", "date", "alert_type").join(ids, "location_id", "left_anti")


def latest_load(loc: DataFrame, raw: DataFrame) -> DataFrame:
    """Every location of the seed with its last load time, or null."""
    loads = raw.groupBy("location_id").agg(F.max("_extracted_at").alias("latest_extracted_at"))
    return loc.select("location_id").join(loads, "location_id", "left")


def pending_locations(loc: DataFrame, raw: DataFrame, start: Column, column: str = "date", days: int = 7) -> DataFrame:
    """Seed locations without a row in the first ``days`` days from ``start``."""
    c = F.col(column)
    first_days = raw.filter((c >= start) & (c < F.date_add(start, days)))
    return loc.join(first_days.select("location_id").distinct(), "location_id", "left_anti")


def profile_diff(actual: DataFrame, hist: DataFrame) -> DataFrame:
    """Day profile beside the history profile, by hour."""
    joined = actual.join(hist, "hour", "left")
    return joined.withColumn("diff_temp", rounded(F.col("temp") - F.col("avg_temp"), 1))


def by_season(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """Readings, mean temperature and total rain by calendar year and season."""
    calendar = small_side(dim.select(F.col("dt_data").alias("date"), "ano", "estacao"))
    return (
        daily.select("date", "temp_avg_c", "precipitation_mm")
        .join(calendar, "date")
        .groupBy("ano", "estacao")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            rounded(F.avg("temp_avg_c"), 2).alias("avg_temp"),
            rounded_sum(F.sum("precipitation_mm"), 1).alias("total_mm"),
        )
    )
