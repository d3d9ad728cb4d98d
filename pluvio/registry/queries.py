"""One named query per operator, over the tables of ``sources.driver_tables``."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pluvio import schemas
from pluvio.config import HOT_ROWS
from pluvio.functions import calendar as cal, climate, values
from pluvio.operators import audit, filters as fl, joins, quality as dq, reports as rp
from pluvio.operators.rolling import rolling_avg
from pluvio.operators.staging import dedup_latest, hottest, require, stg_daily, stg_hourly
from pluvio.plans import layers, models
from pluvio.plans.layers import Marts, build_marts, open_marts, register_layers
from pluvio.plans.refresh import refresh_daily, refresh_from
from pluvio.plans.suite import run_suite_by_folder
from pluvio.session import configure, stored_state, work_dir
from pluvio.sources import driver_tables, payloads, scans, sinks
from pluvio.sources.versions import VersionedTable
from pluvio.streaming.ingest import stream_ingest

CITY = "Supplier#000000000"
CITIES = ["Supplier#000000000", "Supplier#000000001", "Supplier#000000002"]
MESO = "ASIA"
RELOAD = ("2000-01-01", "2000-03-31")
REFRESH_FROM = "2000-01-15"
LATE = {"date": ("1997-03-10", "1997-05-02"), "timestamp": ("2024-01-05", "2024-01-09")}
TAIL = {"date": REFRESH_FROM, "timestamp": "2024-01-20"}
INCREMENT_FROM = "2000-01-01 00:00:00"
KEEP_DAILY = ["id", "latitude", "longitude"]
KEEP_HOURLY = ["id", "latitude", "longitude", "elevation", "timezone"]
WALL_CLOCK = ["_loaded_at", "_dbt_updated_at"]

# What the readings and locations are derived from.
TABLES = ("lineitem", "events", "supplier", "nation", "region")

# Folders of marts and landed raw tables already written by this application, by the state of their inputs.
_written: dict[tuple, str] = {}


class Inputs:
    """The tables a query starts from, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.state = tuple(stored_state(spark, f"{sf_dir}/{t}.parquet") for t in TABLES)
        self.spark = configure(spark, sum(size for size, _, _ in self.state))
        self.sf_dir = sf_dir

    def _once(self, name: str, write: Callable[[str], object]) -> str:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.state, name)
        if key not in _written:
            path = work_dir(self.spark, name)
            write(path)
            _written[key] = path
        return _written[key]

    @cached_property
    def locations(self) -> DataFrame:
        return driver_tables.locations(self.spark, self.sf_dir)

    @cached_property
    def raw_daily(self) -> DataFrame:
        return driver_tables.raw_daily(self.spark, self.sf_dir)

    @cached_property
    def raw_hourly(self) -> DataFrame:
        return driver_tables.raw_hourly(self.spark, self.sf_dir)

    @cached_property
    def stg_daily(self) -> DataFrame:
        return stg_daily(self.raw_daily)

    @cached_property
    def stg_by_location(self) -> DataFrame:
        """``stg_daily`` for models that go on by location."""
        return stg_daily(self.raw_daily, by_location=hottest(self.raw_daily) <= HOT_ROWS)

    @cached_property
    def stg_hourly(self) -> DataFrame:
        return stg_hourly(self.raw_hourly)

    @cached_property
    def int_daily(self) -> DataFrame:
        return models.int_daily(self.stg_by_location, self.locations)

    @cached_property
    def daily_facts(self) -> DataFrame:
        """The facts computed from the raw table; ``marts.daily`` are the stored ones."""
        return models.daily_facts(self.int_daily)

    @cached_property
    def hourly_facts(self) -> DataFrame:
        return models.hourly_facts(self.stg_hourly, self.locations)

    @cached_property
    def marts(self) -> StoredMarts:
        return StoredMarts(self)

    @cached_property
    def as_of(self) -> Column:
        return self.marts.as_of

    @cached_property
    def calendar(self) -> DataFrame:
        """The calendar over the readings' own date range."""
        return models.dim_dates(self.spark, self._bound(F.min), self._bound(F.max))

    def _bound(self, pick) -> Column:
        return self.raw_daily.agg(pick("date")).scalar()

    @cached_property
    def now(self) -> Column:
        return self.raw_daily.agg(F.max("_extracted_at")).scalar()

    @cached_property
    def now_all(self) -> Column:
        """Newest load of both raw tables."""
        newest = [df.agg(F.max("_extracted_at").alias("t")) for df in (self.raw_daily, self.raw_hourly)]
        return reduce(DataFrame.unionByName, newest).agg(F.max("t")).scalar()

    def landed(self, name: str) -> str:
        """A raw table or the seed written out, as the scans find it."""
        if name == "locations":
            return self._once(name, lambda path: self.locations.write.csv(path, header=True))
        return self._once(name, lambda path: getattr(self, name).write.parquet(path))

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = work_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def suite_tables(self) -> dict[str, DataFrame]:
        """What the quality suite starts from."""
        return {
            "raw_daily": self.raw_daily, "raw_hourly": self.raw_hourly, "daily_facts": self.marts.daily,
            "hourly_facts": self.marts.hourly, "alerts": self.marts.alerts, "locations": self.locations,
        }

    @cached_property
    def checked(self) -> dict[str, DataFrame]:
        """Every table whose violating rows are stored."""
        return {
            "raw_daily": self.raw_daily, "raw_hourly": self.raw_hourly, "stg_daily": self.stg_daily,
            "stg_hourly": self.stg_hourly, "int_daily": self.int_daily, "daily_facts": self.marts.daily,
            "hourly_facts": self.marts.hourly, "alerts": self.marts.alerts, "dim_datas": self.calendar,
            "locations": self.locations,
        }


class StoredMarts:
    """The tables of ``layers.Marts`` in one folder, each written when first asked for: a report on the hours needs no daily facts."""

    def __init__(self, inputs: Inputs):
        self._inputs = inputs
        # Only the name of the folder; the parts are written as they are needed.
        self._root = inputs._once("marts", lambda path: None)

    def __getattr__(self, name: str):
        i, root = self._inputs, self._root
        build = {
            "daily": lambda _: layers.build_daily(i.spark, i.raw_daily, i.locations, root),
            "alerts": lambda _: layers.build_alerts(i.spark, root),
            "states": lambda _: layers.build_states(i.spark, i.locations, root),
            "hourly": lambda _: layers.build_hourly(i.spark, i.raw_hourly, i.locations, root),
        }
        for part in {"alerts": ["daily", "alerts"], "latest": ["daily", "states"], "hourly": ["hourly"], "coverage": ["hourly"]}.get(name, ["daily"]):
            i._once(f"marts-{part}", build[part])
        return layers.open_mart(i.spark, root, name)



def _polls(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The readings loaded in the morning and those loaded in the afternoon."""
    hour = F.hour("_extracted_at")
    return raw.filter(hour < 12), raw.filter(hour >= 12)


# --- sources and sinks -------------------------------------------------------------------------


def _normalize_timestamps(i: Inputs) -> DataFrame:
    minutes = F.date_format("sunrise", "yyyy-MM-dd'T'HH:mm")
    seconds = F.date_format("_extracted_at", "yyyy-MM-dd'T'HH:mm:ss")
    absent = F.when(F.col("uv_index_max").isNotNull(), F.date_format("sunset", "yyyy-MM-dd'T'HH:mm"))
    return i.raw_daily.select(
        "id", "_extracted_at",
        values.norm_ts(minutes).alias("sunrise_text"),
        values.norm_ts(seconds).alias("extracted_text"),
        values.norm_ts(absent).alias("sunset_text"),
        F.try_to_timestamp(values.norm_ts(minutes)).alias("sunrise"),
    )


def _cast_for_warehouse(i: Inputs) -> DataFrame:
    relational = schemas.with_decimals(schemas.RAW_HOURLY, schemas.HOURLY_DECIMALS)
    typed = i.raw_hourly.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in relational])
    return scans.to_warehouse_types(typed)


def _incremental_read(i: Inputs) -> DataFrame:
    source = scans.read_raw_daily(i.spark, i.landed("raw_daily"))
    target = source.filter(F.col("_extracted_at") <= F.lit(INCREMENT_FROM).cast("timestamp"))
    return scans.read_increment(source, target)


def _with_faults(packed: DataFrame, short: str) -> DataFrame:
    """Payloads as services send them: the array ``short`` lacks its last element, and each location adds a
    cut-off payload and one without readings."""
    shortened = F.regexp_replace("payload", rf'("{short}":\[[^\]]*?),?[^,\[\]]*\]', "$1]")
    good = packed.withColumn("payload", shortened)
    newest = packed.groupBy("location_id").agg(F.max("payload").alias("payload"), F.max("_extracted_at").alias("_extracted_at"))
    cut = newest.withColumn("payload", F.expr("left(payload, length(payload) - 1)"))
    empty = newest.withColumn("payload", F.lit('{"latitude": 1.5, "daily": {"time": []}, "hourly": {}}'))
    return good.unionByName(cut.select(good.columns)).unionByName(empty.select(good.columns))


def _daily_payloads(i: Inputs) -> DataFrame:
    return _with_faults(payloads.pack_daily(dedup_latest(i.raw_daily, ["location_id", "date"])), "rain_sum")


def _hourly_payloads(i: Inputs) -> DataFrame:
    return _with_faults(payloads.pack_hourly(dedup_latest(i.raw_hourly, ["location_id", "timestamp"])), "cloud_cover")


def _rejects(i: Inputs) -> DataFrame:
    parts = [
        payloads.rejects(sent, block).groupBy("reason").agg(F.count(F.lit(1)).alias("payloads")).withColumn("block", F.lit(block))
        for sent, block in ((_daily_payloads(i), "daily"), (_hourly_payloads(i), "hourly"))
    ]
    return parts[0].unionByName(parts[1])


def _append_load(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "append")
    for batch in _polls(i.raw_daily):
        table = sinks.append_load(batch, path, schemas.RAW_DAILY)
    return table


def _table(i: Inputs, name: str, schema, day_of: str) -> VersionedTable:
    folder = work_dir(i.spark, name)
    return VersionedTable(i.spark, folder.split("/")[-1].replace("-", "_"), folder, schema, day_of, ["location_id", day_of])


def _upsert(i: Inputs, raw: DataFrame, schema, key: str, keep: list[str]) -> DataFrame:
    """The morning's readings in a stored table, then the afternoon's upserted, twice."""
    stored = _table(i, "upsert", schema, key)
    morning, afternoon = _polls(raw)
    for batch in (morning, afternoon, afternoon):
        table = stored.upsert(batch, ["location_id", key], keep)
    return table


def _reload(i: Inputs) -> DataFrame:
    """A stored table whose window is reloaded, twice."""
    stored = _table(i, "reload", schemas.RAW_DAILY, "date")
    stored.reload(i.raw_daily, "1900-01-01", unbounded=True)
    batch = i.raw_daily.filter(F.col("date").between(*(F.lit(d).cast("date") for d in RELOAD)))
    batch = batch.withColumn("wind_speed_10m_max", F.col("wind_speed_10m_max") + 1)
    for _ in range(2):
        table = stored.reload(batch, *RELOAD)
    return table


def _ledgers(i: Inputs) -> dict[str, DataFrame]:
    """The load ledgers of stored raw tables after they were emptied, loaded, appended to and reloaded in part."""

    def load(root: str) -> None:
        for name, schema, day_of in (("raw_daily", schemas.RAW_DAILY, "date"), ("raw_hourly", schemas.RAW_HOURLY, "timestamp")):
            raw, stored = getattr(i, name), _ledger_table(i, root, name, schema, day_of)
            morning, afternoon = _polls(raw)
            stored.truncate(afternoon)
            stored.truncate(morning)
            stored.append(afternoon)
            stored.reload(raw.filter(F.to_date(day_of).between(*(F.lit(d).cast("date") for d in LATE[day_of]))), *LATE[day_of])

    root = i._once("ledgers", load)
    return {
        "daily": _ledger_table(i, root, "raw_daily", schemas.RAW_DAILY, "date").ledger(),
        "hourly": _ledger_table(i, root, "raw_hourly", schemas.RAW_HOURLY, "timestamp").ledger(),
    }


def _ledger_table(i: Inputs, root: str, name: str, schema, day_of: str) -> VersionedTable:
    view = f"{root.split('/')[-1]}_{name}".replace("-", "_")
    return VersionedTable(i.spark, view, f"{root}/{name}", schema, day_of, ["location_id", day_of])


def _truncate_reload(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "truncate")
    morning, afternoon = _polls(i.raw_daily)
    sinks.truncate_reload(morning, path, schemas.RAW_DAILY, truncate=True)
    sinks.truncate_reload(afternoon, path, schemas.RAW_DAILY, truncate=False)
    kept = i.spark.read.schema(schemas.RAW_DAILY).parquet(path).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    reloaded = sinks.truncate_reload(afternoon, path, schemas.RAW_DAILY, truncate=True)
    return reloaded.withColumn("rows_before_truncate", F.lit(kept).cast("long"))


def _pending(i: Inputs) -> DataFrame:
    """Locations without a reading in the first seven days of the whole history."""
    return joins.pending_locations(i.locations, i.raw_daily, i._bound(F.min))


def _write_daily(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "daily_facts")
    sinks.write_daily_facts(i.daily_facts, path)
    return scans.read_mart(i.spark, path, schemas.DAILY_FACTS).drop(*WALL_CLOCK)


def _write_hourly(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "hourly_facts")
    sinks.write_hourly_facts(i.hourly_facts, path)
    return scans.read_mart(i.spark, path, schemas.HOURLY_FACTS).drop(*WALL_CLOCK)


def _refresh(i: Inputs, mart: str) -> DataFrame:
    """Marts of the readings before a day, then that day and all later ones added, twice."""
    root = work_dir(i.spark, "refresh")
    build_marts(i.spark, i.raw_daily.filter(F.col("date") < F.lit(REFRESH_FROM).cast("date")), i.raw_hourly, i.locations, root)
    for _ in range(2):
        marts = refresh_daily(i.spark, i.raw_daily, i.locations, root, REFRESH_FROM)
    return getattr(marts, mart).drop(*WALL_CLOCK)


def _propagated(i: Inputs) -> Marts:
    """Marts that follow the loads of stored raw tables: late days in the middle, other values there and days that are none at first."""

    def follow(root: str) -> None:
        stored, raw = _followed(i, root), {"date": i.raw_daily, "timestamp": i.raw_hourly}
        days = {c: F.col(c).cast("date") for c in raw}
        late = {c: day.between(*(F.lit(d).cast("date") for d in LATE[c])) for c, day in days.items()}
        wrong = {
            "date": i.raw_daily.withColumn("temperature_2m_max", F.col("temperature_2m_max") + 9).filter(late["date"] & (F.day("date") % 2 == 0)),
            "timestamp": i.raw_hourly.withColumn("temperature_2m", F.col("temperature_2m") + 9).filter(late["timestamp"]),
        }
        too_new = {
            "date": i.raw_daily.filter(days["date"] >= F.lit(REFRESH_FROM).cast("date")).withColumn("date", F.add_months("date", 50)),
            "timestamp": i.raw_hourly.limit(0),
        }
        for c, table in stored.items():
            first = raw[c].filter(~late[c] & (days[c] < F.lit(TAIL[c]).cast("date")))
            table.reload(first.unionByName(wrong[c]).unionByName(too_new[c]), "1900-01-01", unbounded=True)
        build_marts(i.spark, stored["date"].rows(), stored["timestamp"].rows(), i.locations, root)
        _suite_by_folder(i, root)
        for c, table in stored.items():
            table.reload(raw[c].filter(late[c]), *LATE[c])
            refresh_from(table, i.locations, root)
            table.reload(raw[c].filter(days[c] >= F.lit(TAIL[c]).cast("date")), TAIL[c], unbounded=True)
            refresh_from(table, i.locations, root)

    return open_marts(i.spark, i._once("propagated", follow))


def _followed(i: Inputs, root: str) -> dict[str, VersionedTable]:
    """The raw tables that the marts under ``root`` follow."""
    return {
        "date": _ledger_table(i, root, "raw_daily", schemas.RAW_DAILY, "date"),
        "timestamp": _ledger_table(i, root, "raw_hourly", schemas.RAW_HOURLY, "timestamp"),
    }


def _suite_by_folder(i: Inputs, root: str) -> DataFrame:
    stored = _followed(i, root)
    return run_suite_by_folder(stored["date"], stored["timestamp"], root, i.locations, f"{root}/checks", as_of=open_marts(i.spark, root).as_of)


def _checked_again(i: Inputs) -> DataFrame:
    """The suite after the loads: folders that these left alone keep the results of the suite before them."""
    _propagated(i)
    return _suite_by_folder(i, _written[i.spark.sparkContext.applicationId, i.sf_dir, i.state, "propagated"])


def _register_layers(i: Inputs) -> DataFrame:
    root = work_dir(i.spark, "layers")
    layers = register_layers(i.spark, i.raw_daily, i.raw_hourly, i.locations, root, root.split("/")[-1].replace("-", "_"),
                             start=i._bound(F.min), end=i._bound(F.max))
    counts = [
        i.spark.table(name).agg(
            F.lit(layer).alias("layer"), F.lit(name.split(".")[-1]).alias("object"), F.count(F.lit(1)).alias("total")
        )
        for name, layer in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _stream(i: Inputs) -> DataFrame:
    """Four polls a day, each dropping its files and running the stream until it has caught up."""
    inbox, target, checkpoint = (work_dir(i.spark, n) for n in ("inbox", "stream-table", "stream-checkpoint"))
    for poll in range(4):
        loaded_in = F.floor(F.hour("_extracted_at") / 6) == poll
        i.raw_hourly.filter(loaded_in).write.mode("append").parquet(inbox)
        table = stream_ingest(i.spark, inbox, target, checkpoint, schemas.RAW_HOURLY)
    return table


# --- reports that need more than one call --------------------------------------------------------


def _series(i: Inputs) -> DataFrame:
    return fl.city_series(i.marts.daily, CITY, 90, i.as_of)


def _compared(i: Inputs) -> DataFrame:
    return fl.compare_cities(i.marts.daily, CITIES, "temp_max_c", 90, i.as_of)


def _profile_diff(i: Inputs) -> DataFrame:
    hourly, coverage = i.marts.hourly, i.marts.coverage
    return joins.profile_diff(
        rp.day_profile(hourly, CITY, coverage=coverage), rp.history_profile(hourly, CITY, coverage=coverage))


def _facts_with(i: Inputs, **columns: Column) -> DataFrame:
    return i.stg_daily.select("location_id", "date", *[c.alias(name) for name, c in columns.items()])


def _date_parts(i: Inputs) -> DataFrame:
    return i.stg_hourly.select(
        "location_id", "observed_at", *cal.date_parts(F.col("observed_at"), "year", "month", "day", "quarter", "hour")
    )


def _load_status(i: Inputs) -> DataFrame:
    age, status = values.load_status(F.col("latest_extracted_at"), i.now)
    return joins.latest_load(i.locations, i.raw_daily).select("location_id", age.alias("age_hours"),
                                                             status.alias("status"))


def _anomalies(i: Inputs) -> DataFrame:
    return i.int_daily.select(
        "location_id", "date",
        climate.anomaly(F.col("temp_avg_c"), F.col("temp_avg_30d_c")).alias("temp_anomaly_c"),
        climate.anomaly(F.col("precipitation_mm"), F.col("precip_avg_30d_mm")).alias("precip_anomaly_mm"),
    )


def _store_failures(i: Inputs) -> DataFrame:
    path = work_dir(i.spark, "failures")
    dq.store_failures(i.checked, path, now=i.now, as_of=i.as_of)
    stored = i.spark.read.schema("row string, check string").parquet(path)
    return stored.groupBy("check").agg(F.count("row").alias("failures"))


def _rolling(i: Inputs, name: str, column: str) -> DataFrame:
    return rolling_avg(i.stg_daily, {name: column}).select("location_id", "date", column, name)


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources and sinks
    "scan_raw_daily": lambda i: scans.read_raw_daily(i.spark, i.landed("raw_daily")),
    "scan_raw_hourly": lambda i: scans.read_raw_hourly(i.spark, i.landed("raw_hourly")),
    "scan_locations_csv": lambda i: scans.read_locations(i.spark, i.landed("locations")),
    "flatten_daily_payload": lambda i: payloads.flatten_daily(_daily_payloads(i)),
    "flatten_hourly_payload": lambda i: payloads.flatten_hourly(_hourly_payloads(i)),
    "flatten_rejects": _rejects,
    "normalize_timestamps": _normalize_timestamps,
    "cast_for_warehouse": _cast_for_warehouse,
    "incremental_read": _incremental_read,
    "append_load": _append_load,
    "upsert_daily": lambda i: _upsert(i, i.raw_daily, schemas.RAW_DAILY, "date", KEEP_DAILY),
    "upsert_hourly": lambda i: _upsert(i, i.raw_hourly, schemas.RAW_HOURLY, "timestamp", KEEP_HOURLY),
    "delete_window_reload": _reload,
    "truncate_reload": _truncate_reload,
    "skip_existing_locations": _pending,
    "write_daily_facts": _write_daily,
    "write_hourly_facts": _write_hourly,
    "refresh_daily_facts": lambda i: _refresh(i, "daily"),
    "refresh_alerts": lambda i: _refresh(i, "alerts"),
    "propagate_daily_facts": lambda i: _propagated(i).daily.drop(*WALL_CLOCK),
    "propagate_alerts": lambda i: _propagated(i).alerts.drop(*WALL_CLOCK),
    "propagate_latest": lambda i: rp.latest_per_location(_propagated(i).daily, latest=_propagated(i).latest),
    "propagate_hourly_facts": lambda i: _propagated(i).hourly.drop(*WALL_CLOCK),
    "propagate_coverage": lambda i: _propagated(i).coverage,
    "register_layers": _register_layers,
    # projections and filters
    "stg_daily": lambda i: i.stg_daily.drop(*WALL_CLOCK),
    "stg_hourly": lambda i: i.stg_hourly.drop(*WALL_CLOCK),
    "filter_required_keys": lambda i: require(i.raw_daily, "location_id", "date", "temperature_2m_max"),
    "filter_last_n_days": lambda i: fl.last_n_days(i.marts.daily, 30, i.as_of).drop(*WALL_CLOCK),
    "filter_alerts": lambda i: fl.filter_alerts(i.marts.alerts, 30, MESO, "high", i.as_of).drop(*WALL_CLOCK),
    "distinct_mesoregions": lambda i: fl.mesoregions(i.locations),
    "hourly_cities": lambda i: fl.hourly_cities(i.marts.coverage),
    "available_dates": lambda i: fl.available_dates(i.marts.coverage, CITY),
    "city_directory": lambda i: fl.city_directory(i.locations),
    "hourly_temp_humidity": lambda i: fl.hourly_series(
        i.marts.hourly, CITY, ["temperature_c", "relative_humidity_pct"], 7, i.marts.coverage),
    "hourly_wind_rain": lambda i: fl.hourly_series(
        i.marts.hourly, CITY, ["wind_speed_kmh", "precipitation_mm"], 7, i.marts.coverage),
    "city_climate_series": _series,
    "compare_cities": _compared,
    # joins
    "join_daily_locations": lambda i: models.enrich(i.stg_daily, i.locations).drop(*WALL_CLOCK),
    "join_hourly_locations": lambda i: joins.with_geography(
        i.stg_hourly, joins.small_side(i.locations.select("location_id", *models.HOURLY_GEO)), models.HOURLY_GEO
    ).drop(*WALL_CLOCK),
    "anti_join_orphan_alerts": lambda i: joins.orphan_alerts(i.marts.alerts, i.locations),
    "semi_join_complete_locations": lambda i: audit.count_complete(i.raw_hourly, audit.fullest(i.raw_hourly) - 40),
    "left_join_expected_latest": lambda i: joins.latest_load(i.locations, i.raw_daily),
    "join_hour_profiles": _profile_diff,
    "join_calendar": lambda i: joins.by_season(i.marts.daily, i.calendar),
    # aggregations
    "home_kpis": lambda i: rp.home_kpis(i.marts.daily, as_of=i.as_of),
    "alert_count_7d": lambda i: rp.alert_count(i.marts.alerts, as_of=i.as_of),
    "temp_trend": lambda i: rp.temp_trend(i.marts.daily, as_of=i.as_of),
    "hottest_cities": lambda i: rp.hottest(i.marts.daily, as_of=i.as_of),
    "coldest_cities": lambda i: rp.coldest(i.marts.daily, as_of=i.as_of),
    "meso_temp_trend": lambda i: rp.meso_trend(i.marts.daily, as_of=i.as_of),
    "meso_anomaly": lambda i: rp.meso_anomaly(i.marts.daily, as_of=i.as_of),
    "meso_anomaly_matrix": lambda i: rp.anomaly_matrix(i.marts.daily, as_of=i.as_of),
    "rainiest_cities": lambda i: rp.rainiest(i.marts.daily, as_of=i.as_of),
    "rain_class_distribution": lambda i: rp.rain_classes(i.marts.daily, as_of=i.as_of),
    "meso_rain": lambda i: rp.meso_rain(i.marts.daily, as_of=i.as_of),
    "meso_rain_matrix": lambda i: rp.rain_matrix(i.marts.daily, as_of=i.as_of),
    "alert_severity_kpis": lambda i: rp.severity_kpis(i.marts.alerts, as_of=i.as_of),
    "alerts_by_type": lambda i: rp.alerts_by_type(i.marts.alerts, as_of=i.as_of),
    "alerts_by_city": lambda i: rp.alerts_by_city(i.marts.alerts, as_of=i.as_of),
    "hourly_max_date": lambda i: fl.max_date(i.marts.coverage, CITY),
    "profile_24h": lambda i: rp.profile_24h(i.marts.hourly, CITY, coverage=i.marts.coverage),
    "city_kpis": lambda i: rp.city_kpis(_series(i)),
    "city_rain_days": lambda i: rp.city_rain_days(_series(i)),
    "compare_cities_summary": lambda i: rp.compare_summary(_compared(i)),
    "wet_matrix": lambda i: rp.wet_matrix(i.marts.daily, MESO, as_of=i.as_of),
    "day_profile": lambda i: rp.day_profile(i.marts.hourly, CITY, coverage=i.marts.coverage),
    "history_profile": lambda i: rp.history_profile(i.marts.hourly, CITY, coverage=i.marts.coverage),
    "profile_diff_summary": lambda i: rp.diff_summary(_profile_diff(i)),
    "map_extent": lambda i: rp.map_extent(rp.latest_per_location(i.marts.daily, MESO, i.marts.latest)),
    "raw_row_counts": lambda i: audit.row_counts(daily=i.raw_daily, hourly=i.raw_hourly),
    "distinct_locations": lambda i: audit.distinct_locations(i.raw_daily),
    "rows_per_location": lambda i: audit.rows_per_location(i.raw_daily),
    "incomplete_daily": lambda i: audit.incomplete(i.raw_daily, audit.fullest(i.raw_daily)),
    "mismatched_hourly": lambda i: audit.mismatched(i.raw_hourly, audit.fullest(i.raw_hourly)),
    "incomplete_hourly": lambda i: audit.incomplete(
        i.raw_hourly, audit.fullest(i.raw_hourly), "horas_coletadas", "horas_faltando", "horas_esperadas"),
    "incomplete_since_start": lambda i: audit.incomplete_since(i.raw_daily, i._bound(F.min), i._bound(F.max)),
    # counts and freshness from the load ledgers
    "ledger_row_counts": lambda i: audit.row_counts(**_ledgers(i)),
    "ledger_distinct_locations": lambda i: audit.distinct_locations(_ledgers(i)["daily"]),
    "ledger_rows_per_location": lambda i: audit.rows_per_location(_ledgers(i)["daily"]),
    "ledger_incomplete_daily": lambda i: audit.incomplete(_ledgers(i)["daily"], audit.fullest(_ledgers(i)["daily"])),
    "ledger_mismatched_hourly": lambda i: audit.mismatched(_ledgers(i)["hourly"], audit.fullest(_ledgers(i)["hourly"])),
    "ledger_incomplete_hourly": lambda i: audit.incomplete(
        _ledgers(i)["hourly"], audit.fullest(_ledgers(i)["hourly"]), "horas_coletadas", "horas_faltando", "horas_esperadas"),
    "ledger_expected_latest": lambda i: joins.latest_load(i.locations, _ledgers(i)["daily"]),
    "ledger_source_freshness": lambda i: dq.source_freshness(_ledgers(i), reduce(
        DataFrame.unionByName, [df.select("_extracted_at") for df in _ledgers(i).values()]).agg(F.max("_extracted_at")).scalar()),
    # the same reports with the filters of the pages
    "home_kpis_meso": lambda i: rp.home_kpis(i.marts.daily, MESO, i.as_of),
    "alert_count_7d_meso": lambda i: rp.alert_count(i.marts.alerts, MESO, i.as_of),
    "temp_trend_meso": lambda i: rp.temp_trend(i.marts.daily, 30, MESO, i.as_of),
    "hottest_cities_meso": lambda i: rp.hottest(i.marts.daily, 10, MESO, i.as_of),
    "coldest_cities_meso": lambda i: rp.coldest(i.marts.daily, 10, MESO, i.as_of),
    "rainiest_cities_meso": lambda i: rp.rainiest(i.marts.daily, 30, MESO, i.as_of),
    "rain_class_distribution_meso": lambda i: rp.rain_classes(i.marts.daily, 30, MESO, i.as_of),
    "latest_per_location_meso": lambda i: rp.latest_per_location(i.marts.daily, MESO, i.marts.latest),
    "alert_severity_kpis_meso": lambda i: rp.severity_kpis(i.marts.alerts, 30, MESO, None, i.as_of),
    "alerts_by_type_filtered": lambda i: rp.alerts_by_type(i.marts.alerts, 30, MESO, "high", i.as_of),
    "alerts_by_city_meso": lambda i: rp.alerts_by_city(i.marts.alerts, 30, MESO, None, i.as_of),
    "alerts_by_city_severity": lambda i: rp.alerts_by_city(i.marts.alerts, 30, None, "critical", i.as_of),
    "recent_alerts_filtered": lambda i: rp.recent_alerts(i.marts.alerts, 30, MESO, "high", i.as_of),
    "meso_rain_as_of": lambda i: rp.meso_rain(i.marts.daily, 30, F.date_sub(i.as_of, 100)),
    "meso_rain_matrix_as_of": lambda i: rp.rain_matrix(i.marts.daily, 30, F.date_sub(i.as_of, 100)),
    # windows
    "dedup_latest_daily": lambda i: dedup_latest(i.raw_daily, ["location_id", "date"]),
    "dedup_latest_hourly": lambda i: dedup_latest(i.raw_hourly, ["location_id", "timestamp"]),
    "rolling_temp_30": lambda i: _rolling(i, "temp_avg_30d_c", "temp_avg_c"),
    "rolling_precip_30": lambda i: _rolling(i, "precip_avg_30d_mm", "precipitation_mm"),
    "date_gaps": lambda i: audit.date_gaps(i.marts.daily, as_of=i.as_of),
    "latest_per_location": lambda i: rp.latest_per_location(i.marts.daily, latest=i.marts.latest),
    # sorts and top-k
    "recent_alerts": lambda i: rp.recent_alerts(i.marts.alerts, as_of=i.as_of),
    "city_alerts": lambda i: rp.city_alerts(i.marts.alerts, CITY, as_of=i.as_of),
    "alerts_ordered": lambda i: models.order_alerts(i.marts.alerts).drop(*WALL_CLOCK),
    # column functions
    "surrogate_key": lambda i: i.stg_hourly.select("location_id", "observed_at", values.surrogate_key(
        F.col("location_id"), values.timestamp_text(F.col("observed_at"))).alias("surrogate_key")),
    "date_parts": _date_parts,
    "year_month": lambda i: _facts_with(i, year_month=cal.year_month(F.col("date"))),
    "day_of_week_weekend": lambda i: _facts_with(
        i, day_of_week=cal.dow(F.col("date")), is_weekend=cal.is_weekend(F.col("date"))),
    "temp_mean_amplitude": lambda i: _facts_with(
        i, temp_mean=climate.temp_mean(F.col("temp_max_c"), F.col("temp_min_c")),
        temp_amplitude_c=climate.temp_amplitude(F.col("temp_max_c"), F.col("temp_min_c"))),
    "anomalies": _anomalies,
    "precipitation_class": lambda i: _facts_with(
        i, precipitation_mm=F.col("precipitation_mm"),
        precipitation_class=climate.precipitation_class(F.col("precipitation_mm"))),
    "uv_risk_level": lambda i: _facts_with(
        i, uv_index_max=F.col("uv_index_max"), uv_risk_level=climate.uv_risk(F.col("uv_index_max"))),
    "daylight_hours": lambda i: _facts_with(
        i, daylight_hours=climate.daylight_hours(F.col("sunrise_at"), F.col("sunset_at"))),
    "alert_type": lambda i: i.daily_facts.select("location_id", "date", climate.alert_type().alias("alert_type")),
    "alert_severity": lambda i: i.daily_facts.select("location_id", "date", climate.severity().alias("severity")),
    "wmo_label": lambda i: i.stg_hourly.select(
        "location_id", "observed_at", "wmo_weather_code",
        climate.wmo_label(F.col("wmo_weather_code")).alias("wmo_weather_label")),
    "celsius_to_fahrenheit": lambda i: _facts_with(
        i, max_f=climate.c_to_f(F.col("temp_max_c")), min_f=climate.c_to_f(F.col("temp_min_c"))),
    "beaufort_scale": lambda i: _facts_with(
        i, wind_speed_max_kmh=F.col("wind_speed_max_kmh"), force=climate.beaufort(F.col("wind_speed_max_kmh"))),
    "age_hours_status": _load_status,
    "southern_season": lambda i: _facts_with(i, estacao=cal.season(F.col("date"))),
    "portuguese_names": lambda i: _facts_with(
        i, nm_mes=cal.month_name_pt(F.col("date")), nm_mes_abrev=cal.month_name_pt(F.col("date"), short=True),
        nm_dia_semana=cal.weekday_name_pt(F.col("date")),
        nm_dia_semana_abrev=cal.weekday_name_pt(F.col("date"), short=True)),
    "quarter_labels": lambda i: _facts_with(
        i, nm_trimestre=cal.quarter_labels(F.col("date"))[0], sigla_trimestre=cal.quarter_labels(F.col("date"))[1]),
    # calendar and models
    "date_spine": lambda i: models.date_spine(i.spark, i._bound(F.min), i._bound(F.max)),
    "dim_dates": lambda i: i.calendar,
    "int_daily_enriched": lambda i: i.int_daily.drop(*WALL_CLOCK),
    "daily_facts": lambda i: i.daily_facts.drop(*WALL_CLOCK),
    "hourly_facts": lambda i: i.hourly_facts.drop(*WALL_CLOCK),
    "climate_alerts": lambda i: models.climate_alerts(i.daily_facts).drop(*WALL_CLOCK),
    # data quality
    "dq_not_null": lambda i: dq.not_null(i.stg_daily, "temp_max_c").drop(*WALL_CLOCK),
    "dq_unique": lambda i: dq.unique(i.raw_daily, "id"),
    "dq_accepted_values": lambda i: dq.accepted_values(
        i.marts.daily, "precipitation_class", ["dry", "light", "moderate"]).drop(*WALL_CLOCK),
    "dq_accepted_range": lambda i: dq.accepted_range(i.raw_hourly, "relative_humidity_2m", 0, 100),
    "dq_accepted_range_count": lambda i: dq.accepted_range_count(i.marts.daily, "daylight_hours", 10, 14),
    "dq_min_le_max": lambda i: dq.min_le_max(i.marts.daily),
    "dq_unique_pk": lambda i: dq.unique_pk(i.raw_daily),
    "dq_location_freshness": lambda i: dq.stale_locations(i.locations, i.raw_daily, i.now),
    "dq_source_freshness": lambda i: dq.source_freshness(
        {"daily": i.raw_daily, "hourly": i.raw_hourly}, i.now_all),
    "dq_recent_load_collect": lambda i: dq.recent_load(
        {"hourly": i.raw_hourly, "daily": i.raw_daily}, i.now_all, minutes=30, mode="any"),
    "dq_recent_load_ingest": lambda i: dq.recent_load(
        {"daily": i.raw_daily, "hourly": i.raw_hourly}, i.now_all, hours=7, mode="all"),
    "dq_suite": lambda i: dq.run_suite(i.suite_tables, i.store, as_of=i.as_of),
    "dq_suite_by_folder": _checked_again,
    "dq_store_failures": _store_failures,
    # streaming
    "stream_ingest_upsert": _stream,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bound(build) for name, build in QUERIES.items()}
