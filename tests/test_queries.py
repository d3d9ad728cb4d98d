"""Every named query against its SQL oracle, and the shape of the plans."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from pluvio.registry.queries import QUERIES as own_queries, Inputs

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("region", "nation", "supplier", "lineitem", "events"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    picked = [tuple(_value(r[k]) for k in order) for r in rows]
    return sorted(columns), sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


# The optional training-data queries have tests of their own.
OWN = [name for name in QUERIES if name in own_queries]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(ORACLE)


# Joins by comparing all pairs, and rows handed to Python: no plan may hold one.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas")


@pytest.mark.parametrize("name", OWN)
def test_query_equals_oracle(spark, duck, plan, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    expected = _table([d[0] for d in result.description], result.fetchall())
    assert _table(df.columns, [tuple(r) for r in df.collect()]) == expected
    assert not [operator for operator in UNWANTED if operator in plan(df)]


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_suite_finds_the_planted_defects(spark, plan):
    from pluvio.operators.quality import run_suite

    i = Inputs(spark, SF_DIR)
    suite = run_suite(i.suite_tables, i.store, as_of=i.as_of)
    assert "lineitem" not in plan(suite) and "events" not in plan(suite)  # read once, for the stored summaries
    failed = {r["check"] for r in suite.filter("status = 'fail'").collect()}
    assert {"stg_daily.temp_max_c.not_null", "raw_hourly.relative_humidity_2m.accepted_range",
            "daily_facts.daylight_hours.accepted_range", "no_date_gaps_per_location",
            "raw_data_freshness"} <= failed
    assert not any(c.startswith("dim_datas.") for c in failed)


def test_hot_key_dedup_shuffles_one_row_per_task(spark):
    """A key that holds a third of all rows reaches the exchange once per map task."""
    from pyspark.sql import functions as F

    from pluvio.operators.staging import dedup_latest

    rows = spark.range(0, 30_000, numPartitions=6).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("l"), F.col("id"))).alias("location_id"),
        F.lit("2024-01-01").cast("date").alias("date"),
        F.timestamp_micros(F.col("id")).alias("_extracted_at"),
    )
    df = dedup_latest(rows, ["location_id", "date"])
    assert df.filter("location_id = 'hot'").first().id == 29_997
    assert df.count() == 20_001
