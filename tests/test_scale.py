"""What a query builds, broadcasts and stores grows no faster than it must."""

import glob

import pytest
from pyspark.sql import functions as F

from pluvio import schemas
from pluvio.operators import joins
from pluvio.plans import refresh
from pluvio.plans.layers import build_marts
from pluvio.plans.state import readings_before
from pluvio.registry.queries import Inputs
from pluvio.session import work_dir
from tests.conftest import plan_of
from tests.test_io import daily, hourly, locations
from tests.test_refresh import LOADS, day, equal_to_rebuilt, reading, world  # noqa: F401


def test_a_side_beyond_the_limit_is_not_broadcast_for_its_small_file(spark):
    path = work_dir(spark, "side")
    spark.range(1000).select(F.lit("a long text that is stored once").alias("text"), "id").write.parquet(path)
    side, rows = spark.read.parquet(path), spark.range(10)
    assert "BroadcastHashJoin" in plan_of(rows.join(joins.small_side(side), "id"))
    assert "SortMergeJoin" in plan_of(rows.join(joins.small_side(side, 1000), "id", "left"))


@pytest.mark.parametrize("name", ["late days in a gap", "newest removed"])
def test_refresh_where_the_reached_months_are_too_many_to_broadcast(spark, rows, world, monkeypatch, name):  # noqa: F811
    raw, hours, loc, root = world
    monkeypatch.setattr(refresh, "REACHED_LIMIT_BYTES", 0)
    LOADS[name](spark, raw)
    refresh.refresh_from(raw, loc, root)
    equal_to_rebuilt(spark, rows, raw, hours, loc, root)


def test_window_states_hold_each_reading_once(spark, rows):
    # One reading a month: all stay among the last 29 for the whole time.
    raw, root = daily(spark, *[reading("a", 31 * n) for n in range(12)]), work_dir(spark, "marts")
    build_marts(spark, raw, hourly(spark, {}), locations(spark, "a"), root)
    states = spark.read.schema(schemas.WINDOW_STATE).parquet(f"{root}/window_state")
    assert [r[0] for r in rows(states.select(F.explode("readings.date").alias("date")))] == [day(31 * n) for n in range(12)]
    assert states.agg(F.max("n")).first()[0] == 12


def test_reports_on_the_hours_write_no_daily_facts(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    inputs._once = lambda name, write, done={}: done[name] if name in done else (done.setdefault(name, work_dir(spark, name)), write(done[name]))[0]
    assert inputs.marts.coverage.count() and inputs.marts.hourly.count()
    root = inputs.marts._root.split(":")[-1]
    assert glob.glob(f"{root}/hourly_facts/*") and not glob.glob(f"{root}/daily_facts*") and not glob.glob(f"{root}/window_state*")
    assert inputs.marts.latest.count() and glob.glob(f"{root}/window_state/*") and not glob.glob(f"{root}/alerts*")


@pytest.mark.parametrize("limit", [0, 1024 * 1024])
def test_changes_without_a_location_reach_nothing(spark, rows, world, monkeypatch, limit):  # noqa: F811
    raw, hours, loc, root = world
    monkeypatch.setattr(refresh, "REACHED_LIMIT_BYTES", limit)
    changed = spark.createDataFrame([(None, day(3)), ("a", None)], "location_id string, date date")
    refresh.propagate_daily(spark, changed, raw, loc, root)
    equal_to_rebuilt(spark, rows, raw, hours, loc, root)


def test_rows_that_no_run_reaches_are_kept_without_a_shuffle(spark, rows):
    path = work_dir(spark, "kept")
    months = F.to_date(F.concat_ws("-", F.lit("2000"), F.col("id") % 12 + 1, F.lit("01")))
    spark.range(24).select(F.concat(F.lit("l"), F.col("id") % 2).alias("location_id"), months.alias("date"), "id").write.parquet(path)
    stored = spark.read.parquet(path)
    runs = spark.sql("VALUES ('l0', DATE'2000-01-01', DATE'2000-11-01'), ('l1', DATE'2000-02-01', DATE'2000-10-01')").toDF("location_id", "start", "end")
    held = {r.location_id: r for r in runs.collect()}
    for later in (False, True):
        first = F.add_months("start", 1) if later else F.col("start")
        found = [refresh._unreached(stored, runs, few, F.trunc("date", "month"), first) for few in (True, False)]
        assert all("Exchange hashpartitioning" not in plan_of(df) for df in found)
        begin = {of: refresh._next_month(run.start) if later else run.start for of, run in held.items()}
        kept = sorted(r.id for r in stored.collect() if not begin[r.location_id] <= r.date <= held[r.location_id].end)
        assert kept and all(sorted(r.id for r in df.collect()) == kept for df in found)


def test_stored_tables_are_compressed_with_zstd(spark, world):  # noqa: F811
    root = world[3].split(":")[-1]
    files = glob.glob(f"{root}/daily_facts/*/*.parquet")
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_what_a_refresh_reaches_is_not_broadcast_for_its_small_file(spark, rows, world):  # noqa: F811
    raw, _, _, root = world
    changed = refresh._stored(raw.rows().filter(F.col("date") >= F.lit(day(60))).select("location_id", "date"), "changed")
    states = spark.read.schema(schemas.WINDOW_STATE).parquet(f"{root}/window_state")
    horizon = day(152)
    runs = refresh.reached_runs(changed, states, horizon)
    assert "BroadcastHashJoin" not in plan_of(runs)
    # From the first change on, through months without one, up to the last that a mean looks back on.
    assert rows(runs) == [(s, first, horizon) for s, first in (("a", day(60)), ("b", day(60)), ("x", day(91)))]
    starts = runs.hint("merge").select("location_id", F.date_format("start", "yyyy-MM").alias("before"), "start")
    earlier = readings_before(states, starts)
    assert "BroadcastHashJoin" not in plan_of(earlier) and earlier.count() == 29 + 29
