"""Aggregated reports over the marts.

Every group-by aggregates before its shuffle, so a hot city, date or class costs no more than
any other group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pluvio.functions.values import rounded, rounded_sum
from pluvio.operators.filters import (
    as_date, filter_alerts, hourly_window, in_mesoregion, last_day, last_n_days, latest_date, of_city, recent, stored_city,
)

# The mark shown before each severity.
SEVERITY_MARKS = {"critical": "🔴", "high": "🟠", "medium": "🟡", "low": "🟢"}


def _avg(column: str, digits: int, name: str) -> Column:
    return rounded(F.avg(column), digits).alias(name)


def home_kpis(daily: DataFrame, meso: str | None = None, as_of=None, n: int = 7) -> DataFrame:
    per_location = F.sum("precipitation_mm") / F.nullif(F.countDistinct("location_id"), F.lit(0))
    return recent(daily, n, meso, as_of).agg(
        _avg("temp_max_c", 1, "avg_max"),
        _avg("temp_min_c", 1, "avg_min"),
        _avg("temp_avg_c", 1, "avg_temp"),
        rounded(per_location, 1).alias("avg_precip"),
        _avg("temp_anomaly_c", 2, "avg_anomaly"),
    )


def alert_count(alerts: DataFrame, meso: str | None = None, as_of=None, n: int = 7) -> DataFrame:
    return recent(alerts, n, meso, as_of).agg(F.count(F.lit(1)).alias("total"))


def temp_trend(daily: DataFrame, n: int = 30, meso: str | None = None, as_of=None) -> DataFrame:
    return (
        recent(daily, n, meso, as_of)
        .groupBy("date")
        .agg(_avg("temp_max_c", 1, "temp_max"), _avg("temp_min_c", 1, "temp_min"), _avg("temp_avg_c", 1, "temp_avg"))
        .orderBy("date")
    )


def hottest(daily: DataFrame, k: int = 10, meso: str | None = None, as_of=None, n: int = 7) -> DataFrame:
    return (
        recent(daily, n, meso, as_of)
        .groupBy("city_name", "mesoregion")
        .agg(_avg("temp_max_c", 1, "media_max"))
        .orderBy(F.desc("media_max"), "city_name", "mesoregion")
        .limit(k)
    )


def coldest(daily: DataFrame, k: int = 10, meso: str | None = None, as_of=None, n: int = 7) -> DataFrame:
    return (
        recent(daily, n, meso, as_of)
        .groupBy("city_name", "mesoregion")
        .agg(_avg("temp_min_c", 1, "media_min"))
        .orderBy("media_min", "city_name", "mesoregion")
        .limit(k)
    )


def meso_trend(daily: DataFrame, n: int = 30, meso: str | None = None, as_of=None) -> DataFrame:
    by_day = recent(daily, n, meso, as_of).groupBy("date", "mesoregion")
    return by_day.agg(_avg("temp_avg_c", 1, "temp_avg")).orderBy("date", "mesoregion")


def meso_anomaly(daily: DataFrame, n: int = 30, as_of=None) -> DataFrame:
    by_day = last_n_days(daily, n, as_of).groupBy("date", "mesoregion")
    return by_day.agg(_avg("temp_anomaly_c", 2, "anomaly")).orderBy("date", "mesoregion")


def meso_rain(daily: DataFrame, n: int = 30, as_of=None) -> DataFrame:
    by_day = last_n_days(daily, n, as_of).groupBy("date", "mesoregion")
    return by_day.agg(_avg("precipitation_mm", 1, "avg_precip")).orderBy("date", "mesoregion")


def day_columns(n: int) -> list[str]:
    """Column names of a matrix over n days: ``d_000`` is ``as_of - n``."""
    return [f"d_{offset:03d}" for offset in range(n + 1)]


def _by_day_offset(per_day: DataFrame, row: str, value: str, n: int, as_of) -> DataFrame:
    """Rows of (row, date, value) as one line per ``row`` with a column per day, null where absent."""
    name = F.format_string("d_%03d", F.date_diff("date", F.date_sub(as_date(as_of), n)))
    cells = per_day.dropna(subset=[row]).withColumn("day_offset", name)
    return cells.groupBy(row).pivot("day_offset", day_columns(n)).agg(F.max(value))


def anomaly_matrix(daily: DataFrame, n: int = 30, as_of=None) -> DataFrame:
    as_of = latest_date(daily) if as_of is None else as_of
    return _by_day_offset(meso_anomaly(daily, n, as_of), "mesoregion", "anomaly", n, as_of)


def rain_matrix(daily: DataFrame, n: int = 30, as_of=None) -> DataFrame:
    as_of = latest_date(daily) if as_of is None else as_of
    return _by_day_offset(meso_rain(daily, n, as_of), "mesoregion", "avg_precip", n, as_of).fillna(0.0)


def wet_matrix(daily: DataFrame, meso: str, n: int = 30, as_of=None) -> DataFrame:
    """Daily rain of each city of a mesoregion."""
    as_of = latest_date(daily) if as_of is None else as_of
    per_day = recent(daily, n, meso, as_of).groupBy("date", "city_name").agg(
        rounded_sum(F.sum("precipitation_mm"), 1).alias("precipitation_mm")
    )
    return _by_day_offset(per_day, "city_name", "precipitation_mm", n, as_of).fillna(0.0)


def _first(ranked: DataFrame, k: int | None) -> DataFrame:
    return ranked if k is None else ranked.limit(k)


def rainiest(daily: DataFrame, n: int = 30, meso: str | None = None, as_of=None, k: int | None = 20) -> DataFrame:
    """The k cities with most rain, or every city of one mesoregion."""
    ranked = (
        recent(daily, n, meso, as_of)
        .groupBy("city_name", "mesoregion")
        .agg(
            rounded_sum(F.sum("precipitation_mm"), 1).alias("total_mm"),
            F.count_if(F.col("precipitation_mm") > 0).alias("dias_chuva"),
        )
        .orderBy(F.desc("total_mm"), "city_name", "mesoregion")
    )
    return _first(ranked, k if meso is None else None)


def rain_classes(daily: DataFrame, n: int = 30, meso: str | None = None, as_of=None) -> DataFrame:
    classes = recent(daily, n, meso, as_of).groupBy("precipitation_class").agg(F.count(F.lit(1)).alias("qtd"))
    return classes.orderBy(F.desc("qtd"), "precipitation_class")


def latest_per_location(daily: DataFrame, meso: str | None = None, latest: DataFrame | None = None) -> DataFrame:
    """Last day of each location that has a mesoregion, with the marker size of the map.

    With the marts' table of ``latest`` readings no other is read.
    """
    last = in_mesoregion((daily if latest is None else latest).filter(F.col("mesoregion").isNotNull()), meso)
    if latest is None:
        newest = Window.partitionBy("location_id").orderBy(F.desc("date"))
        last = last.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
    return last.select(
        "location_id", "city_name", "mesoregion", "latitude", "longitude", "temp_max_c", "precipitation_mm",
        F.greatest(F.coalesce("precipitation_mm", F.lit(0.0)), F.lit(1.0)).alias("marker_size"),
    )


# The map's view when no mesoregion is chosen.
DEFAULT_VIEW = {"center_lat": -27.2, "center_lon": -50.5, "zoom": 5.5}


def map_extent(latest: DataFrame, focused: bool = True) -> DataFrame:
    """Centre, spread and zoom of a set of markers; ``focused=False`` gives the fixed full view."""
    extent = latest.agg(
        F.avg("latitude").alias("center_lat"),
        F.avg("longitude").alias("center_lon"),
        F.greatest(F.max("latitude") - F.min("latitude"), F.max("longitude") - F.min("longitude")).alias("spread"),
    )
    extent = extent.withColumn("zoom", F.when(F.col("spread") < 1, 8.0).when(F.col("spread") < 1.5, 7.5).otherwise(7.0))
    return extent if focused else extent.withColumns({name: F.lit(v) for name, v in DEFAULT_VIEW.items()})


def severity_kpis(alerts: DataFrame, n: int = 30, meso: str | None = None, severity: str | None = None,
                  as_of=None) -> DataFrame:
    return filter_alerts(alerts, n, meso, severity, as_of).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("severity") == level).alias(level) for level in SEVERITY_MARKS],
    )


def alerts_by_type(alerts: DataFrame, n: int = 30, meso: str | None = None, severity: str | None = None,
                   as_of=None) -> DataFrame:
    groups = filter_alerts(alerts, n, meso, severity, as_of).groupBy("alert_type", "severity")
    return groups.agg(F.count(F.lit(1)).alias("qtd")).orderBy(F.desc("qtd"), "alert_type", "severity")


def alerts_by_city(alerts: DataFrame, n: int = 30, meso: str | None = None, severity: str | None = None,
                   as_of=None, k: int | None = 15) -> DataFrame:
    """The k cities with most alerts, or every city of one mesoregion."""
    groups = filter_alerts(alerts, n, meso, severity, as_of).groupBy("city_name", "mesoregion")
    ranked = groups.agg(F.count(F.lit(1)).alias("alertas")).orderBy(F.desc("alertas"), "city_name", "mesoregion")
    return _first(ranked, k if meso is None else None)


def recent_alerts(alerts: DataFrame, n: int = 30, meso: str | None = None, severity: str | None = None,
                  as_of=None, k: int = 200) -> DataFrame:
    """Newest alerts, severity as text ascending within a day."""
    marks = F.create_map(*[F.lit(x) for pair in SEVERITY_MARKS.items() for x in pair])
    label = F.concat(F.coalesce(F.try_element_at(marks, F.col("severity")), F.lit("")), F.lit(" "), F.col("severity"))
    return (
        filter_alerts(alerts, n, meso, severity, as_of)
        .orderBy(F.desc("date"), "severity", "location_id")
        .limit(k)
        .select(
            "date", "city_name", "mesoregion", "alert_type", "severity", label.alias("sev_label"),
            rounded(F.col("temp_max_c"), 1).alias("temp_max"),
            rounded(F.col("temp_anomaly_c"), 1).alias("anomalia"),
            rounded(F.col("precipitation_mm"), 1).alias("precip"),
            rounded(F.col("wind_speed_max_kmh"), 1).alias("vento_max"),
            "uv_index_max",
        )
    )


def city_alerts(alerts: DataFrame, city: str, n: int = 90, as_of=None, k: int = 100) -> DataFrame:
    return (
        of_city(last_n_days(alerts, n, as_of), city)
        .orderBy(F.desc("date"), "location_id")
        .limit(k)
        .select(
            "date", "alert_type", "severity",
            rounded(F.col("temp_max_c"), 1).alias("temp_max"),
            rounded(F.col("temp_anomaly_c"), 1).alias("anomalia"),
            rounded(F.col("precipitation_mm"), 1).alias("precip"),
            rounded(F.col("wind_speed_max_kmh"), 1).alias("vento"),
            "uv_index_max",
        )
    )


def city_kpis(series: DataFrame) -> DataFrame:
    return series.agg(
        _avg("temp_max_c", 1, "mean_max"),
        _avg("temp_min_c", 1, "mean_min"),
        rounded_sum(F.coalesce(F.sum("precipitation_mm"), F.lit(0.0)), 1).alias("total_mm"),
        _avg("temp_anomaly_c", 1, "mean_anomaly"),
    )


def city_rain_days(series: DataFrame) -> DataFrame:
    return series.agg(
        rounded_sum(F.coalesce(F.sum("precipitation_mm"), F.lit(0.0)), 1).alias("total_mm"),
        F.count_if(F.col("precipitation_mm") > 0).alias("rain_days"),
        F.count(F.lit(1)).alias("total_days"),
    )


def compare_summary(compared: DataFrame) -> DataFrame:
    return compared.groupBy("city_name").agg(
        rounded(F.min("valor"), 1).alias("minimo"),
        rounded(F.max("valor"), 1).alias("maximo"),
        _avg("valor", 1, "media"),
    )


def profile_24h(hourly: DataFrame, city: str, n: int = 7, coverage: DataFrame | None = None) -> DataFrame:
    rain_per_day = F.sum("precipitation_mm") / F.nullif(F.countDistinct("date"), F.lit(0))
    return (
        hourly_window(hourly, city, n, coverage)
        .groupBy("hour")
        .agg(
            _avg("temperature_c", 1, "avg_temp"),
            _avg("relative_humidity_pct", 1, "avg_humidity"),
            _avg("wind_speed_kmh", 1, "avg_wind"),
            rounded(rain_per_day, 2).alias("avg_precip_dia"),
        )
        .orderBy("hour")
    )


def day_profile(hourly: DataFrame, city: str, day=None, coverage: DataFrame | None = None) -> DataFrame:
    """Hour averages of one date, by default the city's last."""
    own = stored_city(hourly, city, coverage)
    day = as_date(last_day(hourly, city, coverage) if day is None else day)
    by_hour = own.filter(F.col("date") == day).groupBy("hour")
    return by_hour.agg(_avg("temperature_c", 1, "temp"), _avg("relative_humidity_pct", 1, "humidity")).orderBy("hour")


def history_profile(hourly: DataFrame, city: str, day=None, n: int = 30,
                    coverage: DataFrame | None = None) -> DataFrame:
    """Hour averages of the n days before a date, the date itself left out."""
    own = stored_city(hourly, city, coverage)
    day = as_date(last_day(hourly, city, coverage) if day is None else day)
    before = own.filter((F.col("date") >= F.date_sub(day, n)) & (F.col("date") < day))
    return (
        before.groupBy("hour")
        .agg(_avg("temperature_c", 1, "avg_temp"), _avg("relative_humidity_pct", 1, "avg_humidity"))
        .orderBy("hour")
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.agg(
        _avg("diff_temp", 1, "avg_diff"), F.max("diff_temp").alias("max_diff"), F.min("diff_temp").alias("min_diff")
    )
