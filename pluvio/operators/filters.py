"""Trailing windows, filters and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pluvio.functions.calendar import year_month
from pluvio.functions.values import rounded

# Metrics a comparison may be asked for.
METRICS = ("temp_max_c", "temp_min_c", "temp_avg_c", "precipitation_mm")


def as_date(d) -> Column:
    """A date column from a date, a date text or a column."""
    return (d if isinstance(d, Column) else F.lit(d)).cast("date")


def latest_date(df: DataFrame) -> Column:
    """Newest date as a scalar subquery.

    On a mart stored by month only the last month's dates are read: the inner subquery
    needs no column but the partition's.
    """
    if "year_month" in df.columns:
        df = df.filter(F.col("year_month") == df.agg(F.max("year_month")).scalar())
    return df.agg(F.max("date")).scalar()


def last_n_days(df: DataFrame, n: int, as_of=None) -> DataFrame:
    """Rows of the n + 1 dates ``[as_of - n, as_of]``; ``as_of`` is the newest date by default.

    Where the frame has a ``year_month``, the implied month filters prune partition folders.
    """
    last = as_date(latest_date(df) if as_of is None else as_of)
    first = F.date_sub(last, n)
    recent = df.filter(F.col("date").between(first, last))
    if "year_month" in df.columns:
        recent = recent.filter(F.col("year_month").between(year_month(first), year_month(last)))
    return recent


def in_mesoregion(df: DataFrame, meso: str | None) -> DataFrame:
    return df if meso is None else df.filter(F.col("mesoregion") == meso)


def recent(df: DataFrame, n: int, meso: str | None = None, as_of=None) -> DataFrame:
    """Trailing window, then the optional mesoregion; the default ``as_of`` is the whole table's."""
    return in_mesoregion(last_n_days(df, n, as_of), meso)


def filter_alerts(alerts: DataFrame, n: int, meso: str | None = None, severity: str | None = None,
                  as_of=None) -> DataFrame:
    chosen = recent(alerts, n, meso, as_of)
    return chosen if severity is None else chosen.filter(F.col("severity") == severity)


def mesoregions(loc: DataFrame) -> DataFrame:
    return loc.select("mesoregion").dropna().distinct().orderBy("mesoregion")


def hourly_cities(coverage: DataFrame) -> DataFrame:
    return coverage.select("city_name").distinct().orderBy("city_name")


def of_city(df: DataFrame, city: str) -> DataFrame:
    return df.filter(F.col("city_name") == city)


def stored_city(hourly: DataFrame, city: str, coverage: DataFrame | None = None) -> DataFrame:
    """A city's hours. With the ``coverage`` table also the range of its location ids, on which the mart is sorted, so
    that row groups are skipped by their statistics."""
    own = of_city(hourly, city)
    if coverage is None:
        return own
    ids = of_city(coverage, city)
    low, high = (ids.agg(f("location_id")).scalar() for f in (F.min, F.max))
    return own.filter(F.col("location_id").between(low, high))


def max_date(coverage: DataFrame, city: str) -> DataFrame:
    return of_city(coverage, city).agg(F.max("date").alias("max_date"))


def available_dates(coverage: DataFrame, city: str, n: int = 60) -> DataFrame:
    return of_city(coverage, city).select("date").distinct().orderBy(F.desc("date")).limit(n)


def city_directory(loc: DataFrame) -> DataFrame:
    lat, lon = rounded(F.col("latitude"), 4), rounded(F.col("longitude"), 4)
    return (
        loc.filter(F.col("city_name").isNotNull())
        .select(
            "city_name",
            "mesoregion",
            lat.alias("latitude"),
            lon.alias("longitude"),
            "altitude_m",
            rounded(F.abs(lat), 2).alias("abs_latitude"),
            F.when(lat < 0, "S").otherwise("N").alias("ns"),
            rounded(F.abs(lon), 2).alias("abs_longitude"),
            F.when(lon < 0, "W").otherwise("E").alias("ew"),
        )
        .orderBy("city_name")
    )


def last_day(hourly: DataFrame, city: str, coverage: DataFrame | None = None) -> Column:
    """A city's last date, from the small ``coverage`` table where there is one."""
    return of_city(hourly if coverage is None else coverage, city).agg(F.max("date")).scalar()


def hourly_window(hourly: DataFrame, city: str, n: int, coverage: DataFrame | None = None) -> DataFrame:
    """A city's hours of the n days before its own last date, that date included."""
    first = F.date_sub(last_day(hourly, city, coverage), n)
    return stored_city(hourly, city, coverage).filter(F.col("date") >= first)


def hourly_series(hourly: DataFrame, city: str, cols: Sequence[str], n: int,
                  coverage: DataFrame | None = None) -> DataFrame:
    return hourly_window(hourly, city, n, coverage).select("observed_at", *cols).orderBy("observed_at")


def city_series(daily: DataFrame, city: str, n: int, as_of=None) -> DataFrame:
    return (
        of_city(last_n_days(daily, n, as_of), city)
        .select("date", "temp_max_c", "temp_min_c", "temp_avg_c", "temp_anomaly_c", "precipitation_mm",
                "precipitation_class", "wind_speed_max_kmh", "uv_index_max", "uv_risk_level")
        .orderBy("date")
    )


def compare_cities(daily: DataFrame, cities: Sequence[str], metric: str, n: int, as_of=None,
                   most: int | None = None) -> DataFrame:
    """One metric of the chosen cities by day; ``most`` limits how many may be asked for."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if not cities or (most is not None and len(cities) > most):
        raise ValueError("no city to compare" if not cities else f"compare at most {most} cities")
    return (
        last_n_days(daily, n, as_of)
        .filter(F.col("city_name").isin(list(cities)))
        .select("date", "city_name", rounded(F.col(metric), 1).alias("valor"))
        .orderBy("date", "city_name")
    )
