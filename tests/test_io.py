import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pluvio import schemas
from pluvio.operators import audit, filters as fl, joins, reports as rp
from pluvio.operators.staging import dedup_latest
from pluvio.plans.layers import build_marts, counted_places, register_layers
from pluvio.session import work_dir
from pluvio.sources import payloads, scans, sinks
from pluvio.sources.versions import VersionedTable
from pluvio.streaming.ingest import stream_ingest

DAY = dt.date(2024, 1, 1)
NOON = dt.datetime(2024, 1, 1, 12)
KEYS = ["location_id", "date"]
KEEP = ["id", "latitude", "longitude"]


def daily(spark, *readings):
    names = schemas.RAW_DAILY.fieldNames()
    base = dict.fromkeys(names) | {"id": 1, "location_id": "a", "date": DAY, "_extracted_at": NOON}
    return spark.createDataFrame([tuple((base | r)[n] for n in names) for r in readings], schemas.RAW_DAILY)


def hourly(spark, *readings):
    names = schemas.RAW_HOURLY.fieldNames()
    base = dict.fromkeys(names) | {"id": 1, "location_id": "a", "timestamp": NOON, "_extracted_at": NOON}
    return spark.createDataFrame([tuple((base | r)[n] for n in names) for r in readings], schemas.RAW_HOURLY)


def locations(spark, *ids):
    rows = [(i, f"City {i}", "State", "XX", "C", "R", "Meso", -27.0, -50.0, 10.0, "small") for i in ids]
    return spark.createDataFrame(rows, schemas.LOCATIONS)


def later(**delta):
    return NOON + dt.timedelta(**delta)


def test_flatten_short_absent_and_malformed(spark):
    text = json.dumps({
        "latitude": -27.5, "longitude": -50.0,
        "daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [30.5, None],
                  "precipitation_sum": [1.0], "sunrise": ["2024-01-01T05:30", "2024-01-02T05:31"]},
    })
    df = spark.createDataFrame([("a", text, NOON), ("b", "{broken", NOON), ("c", "{}", NOON)],
                               "location_id string, payload string, _extracted_at timestamp")
    got = payloads.flatten_daily(df).orderBy("date").collect()
    assert [(r.location_id, r.date.day, r.temperature_2m_max, r.precipitation_sum, r.rain_sum) for r in got] == [
        ("a", 1, 30.5, 1.0, None), ("a", 2, None, None, None)]
    assert got[1].sunrise == dt.datetime(2024, 1, 2, 5, 31) and got[0].latitude == -27.5


def test_elements_are_converted_one_by_one_and_rejects_are_kept(spark, rows):
    sent = json.dumps({"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00", "2024-01-01T03:00"],
                                  "relative_humidity_2m": [55.0, 60, 1.5, "x"], "temperature_2m": ["y", 2, None, {"z": 1}]}})
    df = spark.createDataFrame(
        [("a", sent, NOON), ("b", "{broken", NOON), ("c", None, NOON), ("d", '{"hourly": {"time": []}}', NOON), ("e", "{}", NOON)],
        "location_id string, payload string, _extracted_at timestamp")
    got = payloads.flatten_hourly(df).orderBy("timestamp").collect()
    assert [(r.relative_humidity_2m, r.temperature_2m) for r in got] == [(55, None), (60, 2.0), (None, None), (None, None)]
    assert rows(payloads.rejects(df, "hourly"), "location_id", "reason") == [
        ("b", "malformed"), ("c", "malformed"), ("d", "no_times"), ("e", "no_times")]


def test_pack_then_flatten_gives_the_rows_back(spark, rows):
    raw = hourly(spark, *[{"timestamp": later(hours=h), "temperature_2m": float(h), "weather_code": h} for h in range(30)])
    packed = payloads.pack_hourly(raw)
    assert packed.count() == 2
    assert rows(payloads.flatten_hourly(packed)) == rows(raw.drop("id"))


def test_increment_is_strictly_newer(spark, rows):
    source = daily(spark, {"id": 1}, {"id": 2, "_extracted_at": later(minutes=1)}, {"id": 3, "_extracted_at": later(hours=1)})
    target = daily(spark, {"id": 1}, {"id": 2, "_extracted_at": later(minutes=1)})
    assert rows(scans.read_increment(source, target), "id") == [(3,)]
    assert scans.read_increment(source, target.limit(0)).count() == 3
    assert scans.read_increment(source, None).count() == 3


def test_warehouse_types(spark):
    relational = schemas.with_decimals(schemas.RAW_DAILY, schemas.DAILY_DECIMALS)
    df = daily(spark, {"temperature_2m_max": 30.25, "sunrise": NOON})
    typed = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in relational])
    got = scans.to_warehouse_types(typed)
    kinds = dict(got.dtypes)
    assert kinds["temperature_2m_max"] == "double" and kinds["date"] == kinds["sunrise"] == "string"
    r = got.first()
    assert (r.temperature_2m_max, r.date, r.sunrise, r.sunset) == (30.25, "2024-01-01", "2024-01-01T12:00:00", None)


def test_locations_round_trip_csv(spark, rows):
    loc = locations(spark, "a", "b").withColumn("city_name", F.lit("Herval d'Oeste, São José"))
    path = work_dir(spark, "csv")
    loc.write.csv(path, header=True)
    assert rows(scans.read_locations(spark, path)) == rows(loc)


def test_upsert_rules(spark):
    target = daily(spark, {"id": 1, "latitude": None, "temperature_2m_max": 1.0}, {"id": 2, "location_id": "b", "rain_sum": 4.0})
    batch = daily(
        spark,
        {"id": 8, "latitude": -27.0, "temperature_2m_max": 9.0, "_extracted_at": later(hours=1)},
        {"id": 9, "latitude": -28.0, "temperature_2m_max": None, "_extracted_at": later(hours=2)},
        {"id": 7, "location_id": "c", "latitude": -29.0},
    )
    got = {r.location_id: r for r in sinks.upsert(target, batch, KEYS, KEEP).collect()}
    # Updated: the last batch row wins, nulls included; the kept columns stay as first inserted, nulls included.
    assert (got["a"].id, got["a"].latitude, got["a"].temperature_2m_max) == (1, None, None)
    assert got["a"]._extracted_at == later(hours=2)
    assert got["b"].rain_sum == 4.0 and (got["c"].id, got["c"].latitude) == (7, -29.0)


def test_upsert_twice_is_upsert_once(spark, rows):
    target = daily(spark, {"id": 1}, {"id": 2, "location_id": "b"})
    batch = daily(spark, {"id": 3, "rain_sum": 2.0}, {"id": 4, "location_id": "c"})
    once = sinks.upsert(target, batch, KEYS, KEEP)
    assert rows(sinks.upsert(once, batch, KEYS, KEEP)) == rows(once)


def versioned(spark, schema=schemas.RAW_DAILY, day_of="date", unit="day"):
    folder = work_dir(spark, "table")
    return VersionedTable(spark, folder.split("/")[-1].replace("-", "_"), folder, schema, day_of, ["location_id", day_of], "part", unit)


def files_of(table, day):
    return {f for f in table.rows().inputFiles() if f"part={day}" in f}


def test_upsert_table_rewrites_only_touched_partitions(spark, rows):
    table, tomorrow = versioned(spark), DAY + dt.timedelta(days=1)
    assert table.rows().count() == 0 and not table.exists()
    table.upsert(daily(spark, {"id": 1}, {"id": 2, "date": tomorrow}), KEYS, KEEP)
    untouched = files_of(table, DAY)
    table.upsert(daily(spark, {"id": 3, "date": tomorrow, "rain_sum": 5.0}, {"id": 4, "date": tomorrow, "location_id": "b"}), KEYS, KEEP)
    assert rows(table.rows(), "id", "rain_sum") == [(1, None), (2, 5.0), (4, None)]
    assert untouched and untouched == files_of(table, DAY)
    assert rows(table.upsert(daily(spark), KEYS, KEEP), "id") == [(1,), (2,), (4,)]
    with pytest.raises(ValueError):
        table.upsert(daily(spark, {"id": 5}), ["location_id"], KEEP)
    with pytest.raises(ValueError):
        VersionedTable(spark, "t", "r", schemas.RAW_DAILY, "day", [])


def test_reload_window_bounded_and_unbounded(spark, rows):
    target = daily(spark, *[{"id": k, "date": DAY + dt.timedelta(days=k)} for k in range(5)])
    batch = daily(spark, {"id": 99, "date": DAY + dt.timedelta(days=1)})
    start, end = DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=2)
    assert rows(sinks.reload_window(target, batch, start, end), "id") == [(0,), (3,), (4,), (99,)]
    assert rows(sinks.reload_window(target, batch, start, end, unbounded=True), "id") == [(0,), (99,)]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_reload_of_a_stored_table(spark, rows, unit):
    table, days = versioned(spark, unit=unit), [DAY + dt.timedelta(days=k) for k in range(5)]
    later_month = DAY + dt.timedelta(days=70)
    table.reload(daily(spark, *[{"id": k, "date": d} for k, d in enumerate([*days, later_month])]), days[0], later_month)
    outside = files_of(table, later_month.replace(day=1) if unit == "month" else later_month)
    batch = daily(spark, {"id": 99, "date": days[1]})
    for _ in range(2):  # day 2 has no new row
        assert rows(table.reload(batch, days[1], days[2]), "id") == [(0,), (3,), (4,), (5,), (99,)]
    assert outside and outside <= set(table.rows().inputFiles())
    for wrong in (days[4], None):
        with pytest.raises(ValueError):
            table.reload(daily(spark, {"id": 77, "date": wrong}), days[1], days[2])
    assert rows(table.rows(), "id") == [(0,), (3,), (4,), (5,), (99,)]
    assert rows(table.reload(daily(spark), days[3], days[4]), "id") == [(0,), (5,), (99,)]
    assert rows(table.reload(batch, days[1], unbounded=True), "id") == [(0,), (99,)]


def test_a_read_begun_before_a_load_returns_the_old_rows(spark, rows):
    table, tomorrow = versioned(spark), DAY + dt.timedelta(days=1)
    table.upsert(daily(spark, {"id": 1}, {"id": 2, "date": tomorrow}), KEYS, KEEP)
    begun = table.rows()
    table.upsert(daily(spark, {"id": 3, "rain_sum": 7.0}, {"id": 4, "location_id": "b", "date": tomorrow}), KEYS, KEEP)
    assert rows(begun, "id", "rain_sum") == [(1, None), (2, None)]
    assert rows(table.rows(), "id", "rain_sum") == [(1, 7.0), (2, None), (4, None)]
    assert rows(spark.sql(f"select id from {table.name} where part = DATE'{DAY}'")) == [(1,)]
    # The version before the last is gone by the next load, with what only it used.
    files = set(begun.inputFiles())
    table.upsert(daily(spark, {"id": 5, "date": tomorrow}, {"id": 6}), KEYS, KEEP)
    assert rows(table.rows(), "id") == [(1,), (2,), (4,)]
    folder = spark._jvm.org.apache.hadoop.fs.Path(table.root)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    left = set()
    while listed.hasNext():
        left.add(listed.next().getPath().toUri().getPath())
    assert not any(f.removeprefix("file://") in left for f in files) and not any("_batch" in f for f in left)


@pytest.mark.parametrize("step", ["_register", "_switch", "_clean"])
def test_a_load_cut_short_leaves_a_whole_table(spark, rows, monkeypatch, step):
    table, tomorrow = versioned(spark), DAY + dt.timedelta(days=1)
    table.upsert(daily(spark, {"id": 1}, {"id": 2, "date": tomorrow}), KEYS, KEEP)

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, step, lost)
        with pytest.raises(RuntimeError):
            table.upsert(daily(spark, {"id": 3, "location_id": "b"}, {"id": 4, "rain_sum": 1.0, "date": tomorrow}), KEYS, KEEP)
    seen = [(1, None), (2, None)] if step != "_clean" else [(1, None), (2, 1.0), (3, None)]
    assert rows(table.rows(), "id", "rain_sum") == seen
    table.upsert(daily(spark, {"id": 5, "location_id": "c"}), KEYS, KEEP)
    assert rows(table.rows(), "id", "rain_sum") == sorted([*seen, (5, None)])
    # What the lost run wrote is removed, but for folders in use.
    load_folders = {f.split("load=")[1].split("/")[0] for f in table.rows().inputFiles()}
    table.upsert(daily(spark, {"id": 6, "location_id": "d"}), KEYS, KEEP)
    assert len(spark.sql(f"show tables like '{table.name}__v*'").collect()) == 2 and load_folders


def test_upsert_refuses_rows_without_a_key(spark, rows):
    table = versioned(spark)
    table.upsert(daily(spark, {"id": 1}), KEYS, KEEP)
    with pytest.raises(ValueError):
        table.upsert(daily(spark, {"id": 2, "date": None}, {"id": 3, "rain_sum": 1.0}), KEYS, KEEP)
    assert rows(table.rows(), "id", "rain_sum") == [(1, None)]


def test_upsert_by_the_day_of_a_key(spark, rows):
    table = versioned(spark, schemas.RAW_HOURLY, "timestamp")
    keys, keep = ["location_id", "timestamp"], ["id"]
    for batch in (hourly(spark, {"id": 1}, {"id": 2, "timestamp": later(days=1)}), hourly(spark, {"id": 3, "temperature_2m": 4.0})):
        table.upsert(batch, keys, keep)
    assert rows(table.rows(), "id", "temperature_2m") == [(1, 4.0), (2, None)]
    assert table.partitions() == {str(DAY), str(DAY + dt.timedelta(days=1))}


def test_the_ledger_equals_the_rows_after_every_kind_of_load(spark, rows):
    table, month = versioned(spark, unit="month"), DAY + dt.timedelta(days=40)
    loads = [
        lambda: table.append(daily(spark, {"id": 1}, {"id": 2, "location_id": "b", "_extracted_at": later(hours=1)}, {"id": 3, "date": month})),
        lambda: table.append(daily(spark, {"id": 4}, {"id": 5, "location_id": None, "date": month, "_extracted_at": None})),
        lambda: table.upsert(daily(spark, {"id": 6, "_extracted_at": later(hours=3)}, {"id": 7, "location_id": "c"}), KEYS, KEEP),
        lambda: table.reload(daily(spark, {"id": 8, "date": month}, {"id": 8, "date": month}), month, month),
        lambda: table.reload(daily(spark), DAY, DAY),
        lambda: table.append(daily(spark)),
        lambda: table.truncate(daily(spark, {"id": 9, "location_id": "z"})),
        lambda: table.truncate(daily(spark)),
    ]
    assert table.ledger().count() == 0
    counts = []
    for load in loads:
        load()
        scan = table.stored().groupBy("part", "location_id").agg(F.count(F.lit(1)).alias("rows"), F.max("_extracted_at").alias("_extracted_at"))
        found = table.ledger().groupBy("part", "location_id").agg(F.sum("rows").alias("rows"), F.max("_extracted_at").alias("_extracted_at"))
        assert rows(found) == rows(scan)
        assert all("/_ledger/" in f for f in found.inputFiles())
        for ask in (audit.rows_per_location, audit.distinct_locations, lambda df: audit.row_counts(raw=df), lambda df: audit.incomplete(df, 3),
                    lambda df: audit.mismatched(df, 2), lambda df: joins.latest_load(locations(spark, "a", "q"), df)):
            assert rows(ask(table.ledger())) == rows(ask(table.rows()))
        counts.append(table.rows().count())
    assert counts == [3, 5, 6, 6, 2, 2, 1, 0]


def test_a_load_computes_its_batch_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for frame in batches:
            seen.add(len(frame))
            yield frame

    batch = daily(spark, *[{"id": k, "date": DAY + dt.timedelta(days=k)} for k in range(40)])
    table = versioned(spark, unit="month")
    table.upsert(batch.select("id", "location_id", "date").mapInPandas(counted, "id long, location_id string, date date").select(
        *[F.col(f.name) if f.name in ("id", "location_id", "date") else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RAW_DAILY]), KEYS, KEEP)
    assert seen.value == 40 and len(table.partitions()) == 2


def test_marts_are_written_in_one_evaluation(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for frame in batches:
            seen.add(len(frame))
            yield frame

    raw = daily(spark, *[{"id": k, "date": DAY + dt.timedelta(days=k)} for k in range(90)])
    facts = spark.createDataFrame(raw.select("location_id", "date").collect(), "location_id string, date date")
    facts = facts.mapInPandas(counted, facts.schema).withColumn("year_month", F.date_format("date", "yyyy-MM"))
    sinks.write_daily_facts(facts, work_dir(spark, "facts"))
    assert seen.value == 90


def test_a_hot_month_is_split_over_files(spark):
    path, setting = work_dir(spark, "hot"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "64k")
    try:
        rows = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("location_id"), F.lit(DAY).alias("date"),
                                          F.lit("2024-01").alias("year_month"))
        sinks.write_daily_facts(rows, path)
    finally:
        spark.conf.unset(setting)
    assert len(spark.read.parquet(path).inputFiles()) >= 4  # a piece per map task at most


def spoil_pages(file):
    """Overwrite all data pages; the footer with its bounds stays."""
    data = bytearray(open(file, "rb").read())
    footer = int.from_bytes(data[-8:-4], "little") + 8
    data[4:-footer] = b"\xff" * (len(data) - footer - 4)
    open(file, "wb").write(data)
    folder, _, name = file.rpartition("/")
    os.remove(f"{folder}/.{name}.crc")  # else the file system finds the change


def test_files_of_a_hot_month_hold_ranges_of_locations_apart(spark, rows):
    """Two thirds of all rows in one month, and a third of the raw rows repeats of one location."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for frame in batches:
            seen.add(len(frame))
            yield frame

    months = F.when(F.col("id") % 3 > 0, F.lit("2024-01")).otherwise(F.concat(F.lit("2023-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")))
    facts = spark.range(9_000).select(F.format_string("l%04d", F.col("id") % 1_000).alias("location_id"), F.col("id").alias("n"),
                                      F.lit(DAY).alias("date"), months.alias("year_month"))
    read_once = facts.mapInPandas(counted, facts.schema)
    raw = facts.unionByName(facts.filter("location_id = 'l0007'").crossJoin(spark.range(300)).select(facts.columns))
    counts = counted_places(raw, "year_month", F.col("year_month"), 31, work_dir(spark, "counts"))
    assert counts.agg(F.sum("rows")).first()[0] < 9_100
    path = work_dir(spark, "hot")
    sinks.placed(read_once, "year_month", KEYS, counts, rows_per_file=1_000).write.partitionBy("year_month").parquet(path)
    assert seen.value == 9_000
    table = spark.read.schema(facts.schema).parquet(path)
    assert rows(table) == rows(facts)
    for month in ("2024-01", "2023-01"):
        files = table.filter(F.col("year_month") == month).groupBy(F.input_file_name().alias("file")).agg(
            F.min("location_id").alias("low"), F.max("location_id").alias("high"), F.count(F.lit(1)).alias("n"))
        found = files.orderBy("low").collect()
        assert all(one.high < other.low for one, other in zip(found, found[1:]))
        assert max(f.n for f in found) < 1_400
        if month == "2024-01":
            assert 5 <= len(found) <= 9
            # Whoever looks for one location reads the pages of its file only.
            for f in found:
                if not f.low <= "l0500" <= f.high:
                    spoil_pages(f.file.removeprefix("file://"))
            assert table.filter("year_month = '2024-01' and location_id = 'l0500'").count() == 6
            with pytest.raises(Exception, match="PARQUET|FAILED_READ|parquet"):
                table.filter("year_month = '2024-01'").select("n", "location_id").collect()


def test_placing_without_rows_or_beyond_a_broadcast(spark, rows, monkeypatch):
    facts = spark.createDataFrame([("a", DAY, "2024-01"), (None, DAY, "2024-01"), ("b", DAY, None)], "location_id string, date date, year_month string")
    counts = spark.createDataFrame([("2024-01", "a", 1)], "year_month string, location_id string, rows long")
    assert rows(sinks.placed(facts, "year_month", KEYS, counts)) == rows(facts)
    assert rows(sinks.placed(facts, "year_month", KEYS, counts.limit(0))) == rows(facts)
    monkeypatch.setattr(sinks, "BROADCAST_LIMIT_BYTES", 0)
    assert rows(sinks.placed(facts, "year_month", KEYS, counts)) == rows(facts)


CITY_QUERIES = {
    "hourly_temp_humidity": lambda m: fl.hourly_series(m.hourly, "City a", ["temperature_c"], 7, m.coverage),
    "hourly_wind_rain": lambda m: fl.hourly_series(m.hourly, "City a", ["wind_speed_kmh"], 7, m.coverage),
    "profile_24h": lambda m: rp.profile_24h(m.hourly, "City a", coverage=m.coverage),
    "day_profile": lambda m: rp.day_profile(m.hourly, "City a", coverage=m.coverage),
    "history_profile": lambda m: rp.history_profile(m.hourly, "City a", coverage=m.coverage),
    "join_hour_profiles": lambda m: joins.profile_diff(
        rp.day_profile(m.hourly, "City a", coverage=m.coverage), rp.history_profile(m.hourly, "City a", coverage=m.coverage)),
    "hourly_cities": lambda m: fl.hourly_cities(m.coverage),
    "available_dates": lambda m: fl.available_dates(m.coverage, "City a"),
    "hourly_max_date": lambda m: fl.max_date(m.coverage, "City a"),
}


def test_city_queries_prune_the_hourly_mart(spark, plan):
    marts = build_marts(spark, daily(spark, {}), hourly(spark, {}, {"id": 2, "timestamp": later(days=1)}), locations(spark, "a"),
                        work_dir(spark, "marts"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plans = {name: plan(query(marts)).splitlines() for name, query in CITY_QUERIES.items()}
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for name, query in CITY_QUERIES.items():
        scans = [line for line in plans[name] if "FileScan" in line and "/hourly_facts" in line]
        assert all("(date" in s.split("PartitionFilters: [")[1].split("PushedFilters")[0] for s in scans), name
        assert bool(scans) == (name not in ("hourly_cities", "available_dates", "hourly_max_date"))
        assert query(marts).count() >= 1 or name == "history_profile"


def test_append_and_truncate(spark, rows):
    path = work_dir(spark, "append")
    assert sinks.append_load(daily(spark, {"id": 1}), path, schemas.RAW_DAILY).count() == 1
    assert sinks.append_load(daily(spark, {"id": 1}), path, schemas.RAW_DAILY).count() == 2
    assert sinks.truncate_reload(daily(spark, {"id": 2}), path, schemas.RAW_DAILY, truncate=False).count() == 3
    assert rows(sinks.truncate_reload(daily(spark, {"id": 3}), path, schemas.RAW_DAILY), "id") == [(3,)]


def test_marts_are_pruned_by_month(spark, plan):
    from pluvio.operators.filters import last_n_days

    raw = daily(spark, *[{"id": k, "date": DAY + dt.timedelta(days=k)} for k in range(120)])
    marts = build_marts(spark, raw, hourly(spark, {}), locations(spark, "a"), work_dir(spark, "marts"))
    assert marts.daily.count() == 120 and marts.daily.columns == schemas.DAILY_FACTS.fieldNames()
    text = plan(last_n_days(marts.daily, 7, "2024-04-20").select("date", "temp_max_c"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "(year_month" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "struct<date:date,temp_max_c:double>" in scan


def test_layers_are_registered(spark):
    root = work_dir(spark, "layers")
    layers = register_layers(spark, daily(spark, {}), hourly(spark, {}), locations(spark, "a"), root, database="layers_test")
    assert {name: spark.table(name).count() for name in layers} == {
        "stg_daily": 1, "stg_hourly": 1, "int_daily": 1, "layers_test.daily_facts": 1, "layers_test.hourly_facts": 1,
        "layers_test.alerts": 0, "layers_test.locations": 1, "layers_test.dim_datas": 2557}
    with pytest.raises(ValueError):
        register_layers(spark, daily(spark, {}), hourly(spark, {}), locations(spark, "a"), work_dir(spark, "layers"), database="layers_test")


def test_stream_equals_batch_and_replays_are_harmless(spark, rows):
    inbox, target, checkpoint = (work_dir(spark, n) for n in ("inbox", "target", "checkpoint"))
    first = hourly(spark, {"id": 1, "temperature_2m": 1.0, "_extracted_at": later(hours=2)},
                   {"id": 2, "timestamp": later(days=1)}, {"id": 3, "location_id": None})
    late = hourly(spark, {"id": 4, "temperature_2m": 4.0, "_extracted_at": later(hours=1)},
                  {"id": 5, "timestamp": later(days=1), "_extracted_at": later(hours=3)})
    expected = rows(dedup_latest(first.unionByName(late).dropna(subset=["location_id"]), ["location_id", "timestamp"]))

    def poll(batch):
        batch.write.mode("append").parquet(inbox)
        return stream_ingest(spark, inbox, target, checkpoint, schemas.RAW_HOURLY)

    poll(first)
    assert rows(poll(late)) == expected
    assert rows(poll(late)) == expected  # the same rows again
    assert rows(stream_ingest(spark, inbox, target, checkpoint, schemas.RAW_HOURLY)) == expected  # nothing new


def test_stream_without_any_valid_row_gives_an_empty_table(spark):
    inbox, target, checkpoint = (work_dir(spark, n) for n in ("inbox", "target", "checkpoint"))
    hourly(spark, {"location_id": None}).write.parquet(inbox)
    assert stream_ingest(spark, inbox, target, checkpoint, schemas.RAW_HOURLY).count() == 0


def test_interrupted_stream_batch_is_finished_from_staging(spark, rows, monkeypatch):
    from pluvio.streaming import ingest

    inbox, target, checkpoint = (work_dir(spark, n) for n in ("inbox", "target", "checkpoint"))
    hourly(spark, {"id": 1}, {"id": 2, "timestamp": later(days=1)}).write.parquet(inbox)

    def cut_short(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "replace_from_staging", cut_short)
        with pytest.raises(Exception, match="lost"):
            stream_ingest(spark, inbox, target, checkpoint, schemas.RAW_HOURLY)
    merges = []
    monkeypatch.setattr(ingest, "merge_latest", lambda *a: merges.append(a))
    table = stream_ingest(spark, inbox, target, checkpoint, schemas.RAW_HOURLY)
    assert rows(table, "id") == [(1,), (2,)] and not merges


@pytest.mark.parametrize("hot_rows", [100_000, 2])
@pytest.mark.parametrize("rows_per_file", [1_000_000, 3])
def test_a_stored_upsert_equals_the_join(spark, rows, monkeypatch, hot_rows, rows_per_file):
    monkeypatch.setattr("pluvio.sources.versions.HOT_ROWS", hot_rows)
    monkeypatch.setattr("pluvio.sources.versions.ROWS_PER_FILE", rows_per_file)
    table = versioned(spark, unit="month")
    old = [{"id": k, "location_id": "abcd"[k % 4], "date": DAY + dt.timedelta(days=k % 40), "latitude": None if k % 3 else 1.0} for k in range(60)]
    old += [{"id": 60, "location_id": None}, {"id": 61}, {"id": 62, "_extracted_at": None}]  # a null key and repeated ones
    new = [{"id": 100 + k, "location_id": "bcde"[k % 4], "date": DAY + dt.timedelta(days=k % 50), "latitude": 2.0, "rain_sum": float(k),
            "_extracted_at": None if k % 7 == 0 else later(hours=k % 5)} for k in range(90)]
    table.append(daily(spark, *old))
    want = rows(sinks.upsert(table.rows(), daily(spark, *new), KEYS, KEEP))
    assert rows(table.upsert(daily(spark, *new), KEYS, KEEP)) == want and len(want) > 63


def test_an_upsert_in_place_keeps_null_keys_apart(spark, rows):
    target = daily(spark, {"id": 1, "location_id": None}, {"id": 2}, {"id": 3})
    batch = daily(spark, {"id": 4, "location_id": None, "rain_sum": 1.0}, {"id": 5, "rain_sum": 2.0}, {"id": 6, "date": None}, {"id": 7, "date": None})
    got = sinks.upsert(target, batch, KEYS, KEEP, by=[F.trunc("date", "month")])
    assert rows(got, "id", "rain_sum") == rows(sinks.upsert(target, batch, KEYS, KEEP), "id", "rain_sum")


def test_a_stored_upsert_shuffles_its_rows_once(spark, monkeypatch):
    seen, publish = [], VersionedTable.publish
    monkeypatch.setattr(VersionedTable, "publish", lambda table, merged, **kw: (seen.append((merged, kw)), publish(table, merged, **kw))[1])
    table = versioned(spark, unit="month")
    for _ in range(2):
        table.upsert(daily(spark, {"id": 1}, {"id": 2, "date": DAY + dt.timedelta(days=40)}), KEYS, KEEP)
        merged, kw = seen.pop()
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan and kw["lying"]
