"""Marts that follow loads: what a batch reaches is computed anew, all else stays as it was."""

import datetime as dt
import glob

import pytest

from pluvio import schemas
from pluvio.operators import reports as rp
from pluvio.plans import refresh
from pluvio.plans.layers import build_marts, open_marts
from pluvio.session import work_dir
from pluvio.sources.versions import VersionedTable
from tests.test_io import daily, hourly, later, locations

FIRST = dt.date(2024, 1, 1)
CLOCK = ("_loaded_at", "_dbt_updated_at")


def day(n):
    return FIRST + dt.timedelta(days=n)


def reading(location, n, value=1.0, **more):
    return {"id": 1000 * n + ord(location[0]), "location_id": location, "date": day(n), "temperature_2m_max": 30.0 + value * (n % 11),
            "temperature_2m_min": 10.0, "precipitation_sum": float(n % 7) * value} | more


def table_of(spark, schema, day_of):
    folder = work_dir(spark, "raw")
    return VersionedTable(spark, folder.split("/")[-1].replace("-", "_"), folder, schema, day_of, ["location_id", day_of])


@pytest.fixture
def world(spark):
    """Five months of two locations, one of them with a gap of six weeks, a third that soon falls silent, one that the seed lacks."""
    raw, hours = table_of(spark, schemas.RAW_DAILY, "date"), table_of(spark, schemas.RAW_HOURLY, "timestamp")
    rows = [reading("a", n) for n in range(150)] + [reading("b", n) for n in range(150) if not 40 <= n < 82]
    rows += [reading("c", n) for n in range(12)] + [reading("x", n) for n in range(100, 104)]
    raw.upsert(daily(spark, *rows), ["location_id", "date"], [])
    hours.upsert(hourly(spark, *[{"id": n, "location_id": s, "timestamp": later(hours=n)} for n in range(0, 900, 5) for s in "ab"]),
                 ["location_id", "timestamp"], [])
    loc, root = locations(spark, "a", "b", "c"), work_dir(spark, "marts")
    build_marts(spark, raw.rows(), hours.rows(), loc, root)
    return raw, hours, loc, root


def state(spark, root):
    known = spark.read.parquet(f"{root}/newest").first()
    table = spark.read.schema(schemas.WINDOW_STATE).parquet(f"{root}/window_state").select("before", "location_id", "n", "first", "readings")
    return known, sorted(map(str, table.collect()))


def equal_to_rebuilt(spark, rows, raw, hours, loc, root):
    fresh = work_dir(spark, "rebuilt")
    build_marts(spark, raw.rows(), hours.rows(), loc, fresh)
    one, other = open_marts(spark, root), open_marts(spark, fresh)
    for name in ("daily", "alerts", "hourly", "coverage", "latest"):
        assert rows(getattr(one, name).drop(*CLOCK)) == rows(getattr(other, name).drop(*CLOCK)), name
    (known, held), (expected, states) = state(spark, root), state(spark, fresh)
    assert known.date == expected.date and set(states) <= set(held)
    assert {s for s in held if s.split("'")[1] <= f"{expected.horizon:%Y-%m}"} == set(states)


LOADS = {
    "correction": lambda spark, t: t.upsert(daily(spark, reading("a", 20, 3.0), reading("a", 21, 4.0)), ["location_id", "date"], []),
    "late days in a gap": lambda spark, t: t.upsert(daily(spark, *[reading("b", n) for n in (50, 79, 80)]), ["location_id", "date"], []),
    "append": lambda spark, t: t.upsert(daily(spark, reading("a", 150), reading("c", 151), reading("b", 260)), ["location_id", "date"], []),
    "new location": lambda spark, t: t.upsert(daily(spark, reading("d", 60), reading("d", 149)), ["location_id", "date"], []),
    "newest removed": lambda spark, t: t.reload(daily(spark, reading("b", 130)), day(125), unbounded=True),
    "a whole month removed": lambda spark, t: t.reload(daily(spark), day(31), day(59)),
    "a location removed": lambda spark, t: t.reload(daily(spark, *[reading("a", n) for n in range(12)]), day(0), day(11)),
}


def test_loads_one_after_another_equal_a_rebuild(spark, rows, world):
    raw, hours, loc, root = world
    for number, load in enumerate(LOADS.values()):
        load(spark, raw)
        refresh.refresh_from(raw, loc, root)
        if number == 3:
            equal_to_rebuilt(spark, rows, raw, hours, loc, root)
    hours.reload(hourly(spark, {"id": 7, "timestamp": later(days=3, hours=5)}, {"id": 8, "location_id": "c", "timestamp": later(days=4)}),
                 later(days=3).date(), later(days=5).date())
    refresh.refresh_from(hours, loc, root)
    refresh.refresh_from(raw, loc, root)  # running one again changes nothing
    equal_to_rebuilt(spark, rows, raw, hours, loc, root)


def test_only_what_is_reached_is_read_and_written(spark, rows, world):
    raw, hours, loc, root = world
    files = lambda table: set(glob.glob(f"{root}/{table}/*/*.parquet"))
    before = {t: files(t) for t in ("daily_facts", "alerts", "window_state", "hourly_facts", "hourly_coverage")}
    raw.upsert(daily(spark, reading("a", 62, 2.0)), ["location_id", "date"], [])
    changed = raw.changes(["location_id", "date"])
    assert rows(changed) == [("a", day(62))]
    # Days 60 to 90 are March; 29 readings after day 62 are over on day 91, the first of April. Whoever reads other months fails.
    for month in ("2024-01", "2024-02", "2024-05"):
        for file in glob.glob(f"{root}/daily_facts/year_month={month}/*.parquet"):
            open(file, "wb").write(b"not to be read")
    refresh.refresh_from(raw, loc, root)
    touched = {t: {f.split("=")[1].split("/")[0] for f in before[t] - files(t)} for t in before}
    assert touched["daily_facts"] == {"2024-03", "2024-04"} and touched["window_state"] == {"2024-04"}
    assert touched["alerts"] <= {"2024-03", "2024-04"} and not touched["hourly_facts"] and not touched["hourly_coverage"]
    hours.upsert(hourly(spark, {"id": 1, "timestamp": later(days=33), "temperature_2m": 5.0}), ["location_id", "timestamp"], [])
    marts = refresh.refresh_from(hours, loc, root)
    touched = {t: {f.split("=")[1].split("/")[0] for f in before[t] - files(t)} for t in before}
    assert touched["hourly_facts"] == {str(later(days=33).date())} and touched["hourly_coverage"] == {"2024-02"}
    # The map reads no facts.
    report = rp.latest_per_location(marts.daily, latest=marts.latest)
    assert all("/latest/" in f for f in report.inputFiles()) and all("/latest/" in f for f in rp.map_extent(report).inputFiles())
    assert rows(report, "location_id") == [("a",), ("b",), ("c",)]


@pytest.mark.parametrize("table", ["daily_facts", "window_state"])
def test_a_refresh_cut_short_is_finished_by_the_next(spark, rows, world, monkeypatch, table):
    raw, hours, loc, root = world
    raw.reload(daily(spark, *[reading("a", n, 5.0) for n in range(20, 160)]), day(20), unbounded=True)
    whole = refresh._finish

    def cut_short(spark, root, name, *rest):
        if name == table and glob.glob(f"{root}/{name}-staging/_SUCCESS"):
            raise RuntimeError("lost")
        whole(spark, root, name, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "_finish", cut_short)
        with pytest.raises(RuntimeError):
            refresh.refresh_from(raw, loc, root)
    refresh.refresh_from(raw, loc, root)
    equal_to_rebuilt(spark, rows, raw, hours, loc, root)


def test_marts_without_any_reading_take_the_first(spark, rows):
    raw, hours = table_of(spark, schemas.RAW_DAILY, "date"), table_of(spark, schemas.RAW_HOURLY, "timestamp")
    loc, root = locations(spark, "a"), work_dir(spark, "marts")
    build_marts(spark, raw.rows(), hours.rows(), loc, root)
    assert refresh.refresh_from(raw, loc, root).daily.count() == 0
    raw.upsert(daily(spark, *[reading("a", n) for n in (3, 40, 120)]), ["location_id", "date"], [])
    hours.upsert(hourly(spark, {}), ["location_id", "timestamp"], [])
    refresh.refresh_from(raw, loc, root)
    refresh.refresh_from(hours, loc, root)
    equal_to_rebuilt(spark, rows, raw, hours, loc, root)


def test_refresh_since_a_day(spark, rows, world):
    raw, hours, loc, root = world
    raw.reload(daily(spark, reading("b", 110, 9.0)), day(101), unbounded=True)
    for source in (raw, raw.rows()):
        refresh.refresh_daily(spark, source, loc, root, day(101))
    equal_to_rebuilt(spark, rows, raw, hours, loc, root)


def test_changed_keys_of_a_load(spark, rows):
    raw = table_of(spark, schemas.RAW_DAILY, "date")
    raw.upsert(daily(spark, *[reading(s, n) for s in "abc" for n in range(5)]), ["location_id", "date"], [])
    raw.upsert(daily(spark, reading("a", 1), reading("a", 2, 7.0), reading("e", 3)), ["location_id", "date"], [])
    # The first is as it was.
    assert rows(raw.changes(["location_id", "date"])) == [("a", day(2)), ("e", day(3))]
    raw.reload(daily(spark, reading("a", 2, 7.0)), day(1), day(2))
    assert rows(raw.changes(["location_id", "date"])) == sorted([(s, day(n)) for s in "abc" for n in (1, 2) if (s, n) != ("a", 2)])
    assert rows(raw.between(day(2), day(3)).filter("location_id = 'a'"), "date") == [(day(2),), (day(3),)]
