"""The layered warehouse: staging as views, marts as tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pluvio import schemas
from pluvio.config import BROADCAST_LIMIT_BYTES, HOT_ROWS, Thresholds
from pluvio.functions.calendar import year_month
from pluvio.operators.joins import measured_bytes
from pluvio.operators.staging import stg_daily, stg_hourly
from pluvio.plans.models import (
    DAILY_GEO, HOURLY_GEO, climate_alerts, daily_facts, derived_hourly, dim_dates, enrich, enrich_hourly, int_daily, rolled_daily,
)
from pluvio.plans.state import CARRIED, horizon_of, latest_readings, window_states
from pluvio.session import write_parquet
from pluvio.sources.scans import read_mart
from pluvio.sources.sinks import placed, write_clustered, write_folders


@dataclass(frozen=True)
class Marts:
    daily: DataFrame
    hourly: DataFrame
    alerts: DataFrame
    # One row per location, city and date of the hourly mart.
    coverage: DataFrame
    # Newest date of the daily mart, stored beside it: reports need not look for it in the mart.
    as_of: Column
    # The newest reading of each location.
    latest: DataFrame


_OPEN: dict[str, Callable[[SparkSession, str], DataFrame | Column]] = {
    "daily": lambda spark, root: read_mart(spark, f"{root}/daily_facts", schemas.DAILY_FACTS),
    "hourly": lambda spark, root: read_mart(spark, f"{root}/hourly_facts", schemas.HOURLY_FACTS),
    "alerts": lambda spark, root: read_mart(spark, f"{root}/alerts", schemas.ALERTS),
    "coverage": lambda spark, root: read_mart(spark, f"{root}/hourly_coverage", schemas.STORED_COVERAGE).select(schemas.HOURLY_COVERAGE.fieldNames()),
    "as_of": lambda spark, root: spark.read.schema("date date").parquet(f"{root}/newest").agg(F.max("date")).scalar(),
    "latest": lambda spark, root: spark.read.schema(schemas.LATEST_READINGS).parquet(f"{root}/latest"),
}


def open_mart(spark: SparkSession, root: str, name: str) -> DataFrame | Column:
    """One table of ``Marts``; the others need not be there."""
    return _OPEN[name](spark, root)


def open_marts(spark: SparkSession, root: str) -> Marts:
    return Marts(**{name: open_mart(spark, root, name) for name in _OPEN})


def coverage_of(hours: DataFrame) -> DataFrame:
    return hours.groupBy("location_id", "city_name", "date").agg(F.count(F.lit(1)).alias("hours")).withColumn("year_month", year_month(F.col("date")))


def write_coverage(hours: DataFrame, path: str) -> None:
    write_clustered(coverage_of(hours), path, "year_month", ["city_name", "date"])


def write_latest(spark: SparkSession, loc: DataFrame, root: str, horizon: dt.date | None) -> None:
    """The newest readings and, from these, the newest date with the horizon (null without readings)."""
    write_newest(write_latest_readings(spark, loc, root, horizon), root, F.lit(horizon).cast("date"))


def write_newest(dated: DataFrame, root: str, horizon: Column) -> None:
    write_parquet(dated.agg(F.max("date").alias("date")).select("date", horizon.alias("horizon")), f"{root}/newest", mode="overwrite")


def write_latest_readings(spark: SparkSession, loc: DataFrame, root: str, horizon: dt.date | None) -> DataFrame:
    """The newest readings, from the window states at the horizon."""
    states = spark.read.schema(schemas.WINDOW_STATE).parquet(f"{root}/window_state")
    states = states.filter(F.lit(False) if horizon is None else F.col("before") == f"{horizon:%Y-%m}")
    write_parquet(latest_readings(states, loc), f"{root}/latest", mode="overwrite")
    return spark.read.schema(schemas.LATEST_READINGS).parquet(f"{root}/latest")


def counted_places(raw: DataFrame, partition: str, value: Column, at_most: int, path: str) -> DataFrame:
    """At most how many readings each folder of a mart will have of a location, from two columns of the raw table; stored under ``path``.

    A folder has a reading a day (an hour) of a location, however often the raw table repeats it: ``raw`` has its rows there.
    """
    n = F.count(F.lit(1))
    counts = raw.groupBy(value.alias(partition), "location_id").agg(F.least(n, F.lit(at_most)).alias("rows"), n.alias("raw")).dropna()
    write_parquet(counts, path, mode="overwrite")
    return raw.sparkSession.read.schema(counts.schema).parquet(path)


def build_marts(spark: SparkSession, raw_daily: DataFrame, raw_hourly: DataFrame, loc: DataFrame, root: str,
                thresholds: Thresholds = Thresholds()) -> Marts:
    """Full rebuild of the marts under ``root``."""
    build_daily(spark, raw_daily, loc, root)
    build_alerts(spark, root, thresholds)
    build_states(spark, loc, root)
    build_hourly(spark, raw_hourly, loc, root)
    return open_marts(spark, root)


def build_daily(spark: SparkSession, raw_daily: DataFrame, loc: DataFrame, root: str) -> None:
    """The daily facts and their newest date. What follows from a row and the seed is added where the row is written, not shuffled.

    Unless a location is hot, one exchange by location serves the dedup and the rolling means.
    """
    month = year_month(F.col("date"))
    months = counted_places(raw_daily, "year_month", month, 31, f"{root}/placing/daily")
    hottest = months.groupBy("location_id").agg(F.sum("raw").alias("n")).agg(F.max("n")).first()[0] or 0
    staged = stg_daily(raw_daily, by_location=hottest <= HOT_ROWS)
    rolled, add = narrowed(rolled_daily(staged).withColumn("year_month", month), loc, DAILY_GEO, enrich)
    rows = placed(rolled, "year_month", ["location_id", "date"], months, widen=add)
    write_folders(daily_facts(rows, known=["year_month"]), f"{root}/daily_facts", "year_month")
    stored = read_mart(spark, f"{root}/daily_facts", schemas.DAILY_FACTS)
    write_newest(stored, root, horizon_of(F.col("date")))


def build_alerts(spark: SparkSession, root: str, thresholds: Thresholds = Thresholds()) -> None:
    """Alerts from the stored facts, which lie by folder already: each task writes what it reads, without an exchange."""
    alerts = climate_alerts(read_mart(spark, f"{root}/daily_facts", schemas.DAILY_FACTS), thresholds)
    write_folders(alerts.sortWithinPartitions("year_month", "location_id", "date"), f"{root}/alerts", "year_month")


def build_states(spark: SparkSession, loc: DataFrame, root: str) -> None:
    """Window states and newest readings from the stored facts."""
    stored = read_mart(spark, f"{root}/daily_facts", schemas.DAILY_FACTS)
    horizon = spark.read.schema("date date, horizon date").parquet(f"{root}/newest").first()["horizon"]
    states = window_states(stored.select("location_id", *CARRIED), F.lit(horizon).cast("date"))
    write_clustered(states, f"{root}/window_state", "before", ["location_id"])
    write_latest_readings(spark, loc, root, horizon)


def build_hourly(spark: SparkSession, raw_hourly: DataFrame, loc: DataFrame, root: str) -> None:
    """The hourly facts and their coverage."""
    day = F.to_date("timestamp")
    days = counted_places(raw_hourly, "date", day, 24, f"{root}/placing/hourly")
    staged, add = narrowed(stg_hourly(raw_hourly).withColumn("date", F.to_date("observed_at")), loc, HOURLY_GEO, enrich_hourly)
    rows = placed(staged, "date", ["location_id", "mesoregion", "observed_at"], days, widen=add)
    write_folders(derived_hourly(rows, known=["date"]), f"{root}/hourly_facts", "date")
    write_coverage(read_mart(spark, f"{root}/hourly_facts", schemas.HOURLY_FACTS), f"{root}/hourly_coverage")


def narrowed(rows: DataFrame, loc: DataFrame, columns: list[str], enrich: Callable) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows to be placed, and what adds the geography to them then; a seed too large to be broadcast is joined before."""
    if measured_bytes(loc.select("location_id", *columns)) > BROADCAST_LIMIT_BYTES:
        return enrich(rows, loc), lambda found: found
    return rows, lambda found: enrich(found, loc)


def register_layers(spark: SparkSession, raw_daily: DataFrame, raw_hourly: DataFrame, loc: DataFrame, root: str,
                    database: str, start="2024-01-01", end="2030-12-31") -> dict[str, str]:
    """Register staging and intermediate models as temp views, marts and seed as tables stored under ``root``.

    Returns the layer of each name to read: views by plain name, tables by ``database.name``. A table of that name
    which lies elsewhere is someone else's: it is an error, and nothing is written.
    """
    for name in ("daily_facts", "hourly_facts", "alerts", "locations", "dim_datas"):
        if spark.catalog.tableExists(f"{database}.{name}"):
            found = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").filter("col_name = 'Location'").first()
            if found is None or not found.data_type.rstrip("/").endswith(f"{root.split(':')[-1].rstrip('/')}/{name}"):
                raise ValueError(f"{database}.{name} is stored outside {root}")
    staged = stg_daily(raw_daily)
    views = {"stg_daily": staged, "stg_hourly": stg_hourly(raw_hourly), "int_daily": int_daily(staged, loc)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)

    build_marts(spark, raw_daily, raw_hourly, loc, root)
    dim_dates(spark, start, end).write.mode("overwrite").parquet(f"{root}/dim_datas")
    loc.write.mode("overwrite").parquet(f"{root}/locations")

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    tables = {
        "daily_facts": (schemas.DAILY_FACTS, "year_month"),
        "hourly_facts": (schemas.HOURLY_FACTS, "date"),
        "alerts": (schemas.ALERTS, "year_month"),
        "locations": (schemas.LOCATIONS, None),
        "dim_datas": (spark.read.parquet(f"{root}/dim_datas").schema, None),
    }
    for name, (schema, partition) in tables.items():
        table = f"{database}.{name}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        split = f"PARTITIONED BY ({partition})" if partition else ""
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {split} LOCATION '{root}/{name}'")
        if partition:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    return {
        "stg_daily": "staging", "stg_hourly": "staging", "int_daily": "intermediate",
        **{f"{database}.{name}": "seeds" if name == "locations" else "marts" for name in tables},
    }
