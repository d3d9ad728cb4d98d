"""Intermediate model, fact tables, alerts and calendar."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pluvio import schemas
from pluvio.config import ROLLING_ROWS, Thresholds
from pluvio.functions import calendar as cal, climate, values
from pluvio.operators.filters import as_date
from pluvio.operators.joins import small_side, with_geography
from pluvio.operators.rolling import rolling_avg

DAILY_GEO = ["city_name", "state_name", "country", "region", "mesoregion", "latitude", "longitude", "altitude_m"]
HOURLY_GEO = ["city_name", "state_name", "region", "mesoregion", "latitude", "longitude"]


def enrich(stg: DataFrame, loc: DataFrame) -> DataFrame:
    """Daily readings with the seed's geography, null where the seed lacks the location. A small seed is broadcast."""
    return with_geography(stg, small_side(loc.select("location_id", *DAILY_GEO)), DAILY_GEO)


def int_daily(stg: DataFrame, loc: DataFrame, rows: int = ROLLING_ROWS, key: str | Sequence[str] = "location_id") -> DataFrame:
    """Staging plus daylight, rolling means and geography.

    Dedup exchanges by (location, date); the rolling window's own exchange then moves at most one
    row per location and day.
    """
    return enrich(rolled_daily(stg, rows, key), loc)


def rolled_daily(stg: DataFrame, rows: int = ROLLING_ROWS, key: str | Sequence[str] = "location_id") -> DataFrame:
    """``int_daily`` but for the geography."""
    rolled = rolling_avg(stg, {"temp_avg_30d_c": "temp_avg_c", "precip_avg_30d_mm": "precipitation_mm"}, rows, key)
    return rolled.withColumn("daylight_hours", climate.daylight_hours(F.col("sunrise_at"), F.col("sunset_at")))


def daily_facts(enriched: DataFrame, known: Collection[str] = ()) -> DataFrame:
    """The daily fact table. Derived columns that are ``known`` stay as they are."""
    date, high, low = F.col("date"), F.col("temp_max_c"), F.col("temp_min_c")
    mean, rain = F.col("temp_avg_c"), F.col("precipitation_mm")
    derived = {
        "surrogate_key": values.surrogate_key(F.col("location_id"), date),
        **{part: F.date_part(F.lit(part), date).cast("int") for part in ("year", "month", "day", "quarter")},
        "year_month": cal.year_month(date),
        "day_of_week": cal.dow(date),
        "is_weekend": cal.is_weekend(date),
        "temp_amplitude_c": climate.temp_amplitude(high, low),
        "temp_anomaly_c": climate.anomaly(mean, F.col("temp_avg_30d_c")),
        "precip_anomaly_mm": climate.anomaly(rain, F.col("precip_avg_30d_mm")),
        "precipitation_class": climate.precipitation_class(rain),
        "uv_risk_level": climate.uv_risk(F.col("uv_index_max")),
        "_dbt_updated_at": F.current_timestamp(),
    }
    return enriched.withColumns({c: v for c, v in derived.items() if c not in known}).select(schemas.DAILY_FACTS.fieldNames())


def climate_alerts(daily: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Facts that meet an alert rule, with type and severity."""
    graded = daily.withColumns(
        {"alert_type": climate.alert_type(thresholds), "severity": climate.severity(thresholds)}
    )
    return graded.filter(F.col("alert_type").isNotNull()).select(schemas.ALERTS.fieldNames())


def order_alerts(alerts: DataFrame) -> DataFrame:
    """Newest first, severity as text descending; the location breaks ties and spreads hot dates."""
    return alerts.orderBy(F.desc("date"), F.desc("severity"), "location_id")


def enrich_hourly(stg: DataFrame, loc: DataFrame) -> DataFrame:
    """Hourly readings with the seed's geography. Staging is partitioned by (location, hour): a small seed is broadcast, a large one shuffles."""
    return with_geography(stg, small_side(loc.select("location_id", *HOURLY_GEO)), HOURLY_GEO)


def hourly_facts(stg: DataFrame, loc: DataFrame) -> DataFrame:
    """The hourly fact table."""
    return derived_hourly(enrich_hourly(stg, loc))


def derived_hourly(joined: DataFrame, known: Collection[str] = ()) -> DataFrame:
    """The hourly fact table from readings with their geography. Derived columns that are ``known`` stay as they are."""
    at = F.col("observed_at")
    derived = {
        "surrogate_key": values.surrogate_key(F.col("location_id"), values.timestamp_text(at)),
        "date": F.to_date(at),
        **{part: F.date_part(F.lit(part), at).cast("int") for part in ("hour", "year", "month")},
        "year_month": cal.year_month(at),
        "wmo_weather_label": climate.wmo_label(F.col("wmo_weather_code")),
        "_dbt_updated_at": F.current_timestamp(),
    }
    return joined.withColumns({c: v for c, v in derived.items() if c not in known}).select(schemas.HOURLY_FACTS.fieldNames())


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """Every date of ``[start, end]``; the bounds are dates, date texts or scalar columns."""
    return spark.range(1).select(F.explode(F.sequence(as_date(start), as_date(end))).alias("date"))


def dim_dates(spark: SparkSession, start="2024-01-01", end="2030-12-31") -> DataFrame:
    """The calendar dimension, 27 columns."""
    d = F.col("date")
    quarter_name, quarter_code = cal.quarter_labels(d)
    columns = {
        "dt_data": d,
        "ano": F.year(d),
        "mes": F.month(d),
        "dia": F.day(d),
        "trimestre": F.quarter(d),
        "semana_ano": cal.sunday_week(d),
        "semana_iso": F.weekofyear(d),
        "dia_semana_num": cal.dow(d),
        "dia_do_ano": F.dayofyear(d),
        "nm_mes": cal.month_name_pt(d),
        "nm_mes_abrev": cal.month_name_pt(d, short=True),
        "nm_dia_semana": cal.weekday_name_pt(d),
        "nm_dia_semana_abrev": cal.weekday_name_pt(d, short=True),
        "estacao": cal.season(d),
        "ano_mes": cal.year_month(d),
        "nm_trimestre": quarter_name,
        "sigla_trimestre": quarter_code,
        "fl_fim_de_semana": cal.is_weekend(d),
        "primeiro_dia_mes": F.trunc(d, "month"),
        "ultimo_dia_mes": F.last_day(d),
        "primeiro_dia_trimestre": F.trunc(d, "quarter"),
        "ultimo_dia_trimestre": F.last_day(F.add_months(F.trunc(d, "quarter"), 2)),
        "primeiro_dia_ano": F.trunc(d, "year"),
        "ultimo_dia_ano": F.last_day(F.add_months(F.trunc(d, "year"), 11)),
        "dt_data_ano_anterior": F.add_months(d, -12),
        "dt_data_ontem": F.date_sub(d, 1),
        "dt_data_amanha": F.date_add(d, 1),
    }
    return date_spine(spark, start, end).select([c.alias(name) for name, c in columns.items()])
