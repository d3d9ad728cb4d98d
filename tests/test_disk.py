"""What loads, marts and checks hold on disk, and how often they shuffle and write their rows."""

import glob

import pytest
from pyspark.sql import functions as F

from pluvio import session
from pluvio.operators import quality as dq
from pluvio.operators.staging import hottest, stg_daily
from pluvio.plans import layers, suite
from pluvio.plans.models import rolled_daily
from pluvio.session import work_dir
from pluvio.sources import versions
from tests.conftest import plan_of
from tests.test_io import daily, locations, versioned
from tests.test_refresh import day, reading

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for folder in folders for name in glob.glob(f"{folder.getPath()}/*/shuffle_*.data")}


def test_a_write_leaves_no_shuffled_files(spark):
    rows, before = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), shuffled_files(spark)
    path = work_dir(spark, "written")
    session.write_parquet(rows, path)
    assert not shuffled_files(spark) - before and spark.conf.get(CLEAN) == "false"
    assert spark.read.parquet(path).count() == 100
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        session.write_parquet(rows, path)
    assert spark.conf.get(CLEAN) == "false"


def test_loads_marts_and_failures_leave_no_shuffled_files(spark):
    table, loc, root = versioned(spark, unit="month"), locations(spark, "a", "b"), work_dir(spark, "marts")
    before = shuffled_files(spark)
    table.reload(daily(spark, *[reading(s, n, uv_index_max=99.0) for s in "ab" for n in range(40)]), day(0), unbounded=True)
    layers.counted_places(table.rows(), "month", F.trunc("date", "month"), 31, f"{root}/counts")
    checks = [c for c in dq.CHECKS if c.table == "raw_daily"]
    dq.store_failures({"raw_daily": table.rows()}, f"{root}/failures", [*checks, dq.Check("raw_daily", "id", "unique")])
    suite.keep_summaries(suite.of_table(table), f"{root}/checks", suite.raw_summary(table, [F.col("location_id")], checks, [], True), "")
    assert not shuffled_files(spark) - before
    assert loc.count() and spark.read.parquet(f"{root}/failures").groupBy("check").count().first()["count"] == 80


def test_a_reload_writes_its_batch_once(spark, rows, monkeypatch):
    written = []
    monkeypatch.setattr(versions, "write_parquet", lambda df, path, *rest: (written.append(path), session.write_parquet(df, path, *rest)))
    table = versioned(spark, unit="month")
    for load in (lambda b: table.reload(b, day(0), day(9)), table.append, table.truncate):
        written.clear()
        load(daily(spark, reading("a", 1)))
        assert sum("/_ledger/" not in path for path in written) == 1
    table.reload(daily(spark, reading("a", 12), reading("a", 40)), day(10), day(50))
    assert rows(table.rows(), "date") == [(day(1),), (day(12),), (day(40),)]
    # Refused rows beside old ones outside the window, in the first month and beyond the last.
    for wrong in ({"date": day(1)}, {"date": day(90)}, {"date": None}):
        folders = set(glob.glob(f"{table.root.split(':')[-1]}/load=*"))
        with pytest.raises(ValueError, match="1 rows"):
            table.reload(daily(spark, reading("a", 13), reading("b", 14) | wrong), day(10), day(50))
        assert set(glob.glob(f"{table.root.split(':')[-1]}/load=*")) == folders
    assert rows(table.rows(), "date") == [(day(1),), (day(12),), (day(40),)]


def test_one_exchange_serves_dedup_and_rolling_means(spark, rows):
    path = work_dir(spark, "raw")
    daily(spark, *[reading(s, n, id=k) for s in "ab" for n in range(40) for k in range(3)]).write.parquet(path)
    raw = spark.read.parquet(path)
    two, one = (rolled_daily(stg_daily(raw, by_location=b)).drop("_loaded_at") for b in (False, True))
    assert plan_of(two).count("Exchange hashpartitioning") == 2 and plan_of(one).count("Exchange hashpartitioning") == 1
    assert rows(one) == rows(two) and hottest(raw) == 120


@pytest.mark.parametrize("hot", [0, 100_000])
def test_marts_with_and_without_a_hot_location(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(layers, "HOT_ROWS", hot)
    root = work_dir(spark, "marts")
    layers.build_daily(spark, daily(spark, *[reading("a", n % 50, id=n) for n in range(150)]), locations(spark, "a"), root)
    assert layers.open_mart(spark, root, "daily").count() == 50
