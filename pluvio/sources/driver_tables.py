"""Readings and locations derived from the order and event tables (see FIXTURES.md).

Suppliers play locations, line items daily readings, events hourly readings. All measures
are multiples of a quarter, so their sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import lit

from pluvio import schemas


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarter_degrees(start: float, steps: Column) -> Column:
    return lit(start) - steps / 4


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    """Wall-clock arithmetic on plain microseconds; the session zone is UTC."""
    return F.timestamp_micros(F.unix_micros(ts) + minutes * 60_000_000)


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


# A location that never reports, with an apostrophe in its name.
SILENT_LOCATION = """(
    'loc_none', "Herval d'Oeste", 'NATION_0', 'XX', 'TPC', 'H', 'AFRICA', -27.0, -51.0, 0.0, 'small'
)"""


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier, plus one location that never reports."""
    key = F.col("s_suppkey")
    size = F.element_at(F.array(*map(lit, ["small", "medium", "large", "metropolitan"])), (key % 4 + 1).cast("int"))
    seed = (
        _table(spark, sf_dir, "supplier")
        .join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(lit("loc_"), key).alias("location_id"),
            F.col("s_name").alias("city_name"),
            F.col("n_name").alias("state_name"),
            lit("XX").alias("state_code"),
            lit("TPC").alias("country"),
            lit("H").alias("region"),
            F.col("r_name").alias("mesoregion"),
            _quarter_degrees(-26.0, key % 13).alias("latitude"),
            _quarter_degrees(-48.5, key % 21).alias("longitude"),
            (key * 10).alias("altitude_m"),
            size.alias("population_class"),
        )
    )
    # An inline table, not a projection of literals: joins keep its key as a column to hash on.
    silent = spark.sql(f"VALUES {SILENT_LOCATION}").toDF(*schemas.LOCATIONS.fieldNames())
    return _typed(seed, schemas.LOCATIONS).unionByName(_typed(silent, schemas.LOCATIONS))


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, part, line, supp = (F.col(f"l_{c}") for c in ("orderkey", "partkey", "linenumber", "suppkey"))
    day = F.col("l_shipdate").cast("timestamp")
    base = F.col("l_quantity") / 2
    no_temp, no_rain = part % 31 == 0, part % 29 == 0
    rain = F.when(order % 5 == 0, ((part * 7 + order) % 320).cast("double")).otherwise(0.0)
    return _typed(
        _table(spark, sf_dir, "lineitem").select(
            (order * 1_000_000 + part * 10 + line).alias("id"),
            # A few readings come from stations that the seed does not know.
            F.concat(F.when(order % 211 == 0, lit("loc_new_")).otherwise(lit("loc_")), supp).alias("location_id"),
            F.to_date("l_shipdate").alias("date"),
            _quarter_degrees(-26.0, supp % 13).alias("latitude"),
            _quarter_degrees(-48.5, supp % 21).alias("longitude"),
            F.when(~no_temp, base + 20.5).alias("temperature_2m_max"),
            F.when(~no_temp & (part % 997 == 0), base + 21.5)
            .when(~no_temp, base + 18.5 - line * 4)
            .alias("temperature_2m_min"),
            F.when(~no_rain, rain / 2).alias("precipitation_sum"),
            F.when(~no_rain, rain / 4).alias("rain_sum"),
            (order % 100).alias("wind_speed_10m_max"),
            _plus_minutes(day, lit(360) - line.cast("long") * 10).alias("sunrise"),
            _plus_minutes(day, lit(1080) + line.cast("long") * 10).alias("sunset"),
            F.when(part % 13 != 0, F.floor(F.col("l_tax") * 100 + 0.5) + line / 2).alias("uv_index_max"),
            _plus_minutes(day, order % 1440).alias("_extracted_at"),
        ),
        schemas.RAW_DAILY,
    )


def raw_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    station = F.floor(F.col("user_id") / 10)  # ten users report for one station
    at = F.col("ts").cast("timestamp")
    return _typed(
        _table(spark, sf_dir, "events").select(
            event.alias("id"),
            F.concat(lit("loc_"), station).alias("location_id"),
            F.date_trunc("hour", at).alias("timestamp"),
            _quarter_degrees(-26.0, station % 13).alias("latitude"),
            _quarter_degrees(-48.5, station % 21).alias("longitude"),
            (station * 10).alias("elevation"),
            lit("America/Sao_Paulo").alias("timezone"),
            (F.floor(F.col("value")) % 45 - 5).alias("temperature_2m"),
            F.when(event % 499 == 0, 105).otherwise((event * 7) % 101).alias("relative_humidity_2m"),
            F.when(F.col("event_type") == "error", (event % 40) / 2).otherwise(0.0).alias("precipitation"),
            ((event * 3) % 125).alias("wind_speed_10m"),
            ((event * 11) % 360).alias("wind_direction_10m"),
            (F.col("user_id") % 30 + 1000).alias("surface_pressure"),
            ((event * 13) % 101).alias("cloud_cover"),
            F.when(event % 50 != 0, (event % 25) * 1000).alias("visibility"),
            F.get_json_object("props", "$.k").alias("weather_code"),
            at.alias("_extracted_at"),
        ),
        schemas.RAW_HOURLY,
    )
