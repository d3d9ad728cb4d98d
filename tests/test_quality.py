import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pluvio.operators import audit, quality as dq

NOW = dt.datetime(2024, 1, 10, 12)


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def loads(spark, *hours_ago):
    rows = [(f"l{k}", None if h is None else NOW - dt.timedelta(hours=h)) for k, h in enumerate(hours_ago)]
    return spark.createDataFrame(rows, "location_id string, _extracted_at timestamp")


def test_declared_suite_has_every_check():
    assert len(dq.CHECKS) == 115 and len({c.name for c in dq.CHECKS}) == 115
    assert Counter(c.kind for c in dq.CHECKS) == {
        "not_null": 66, "accepted_range": 30, "accepted_values": 14, "unique": 5}
    assert Counter(c.table for c in dq.CHECKS) == {
        "raw_daily": 7, "raw_hourly": 7, "stg_daily": 9, "stg_hourly": 12, "int_daily": 3, "daily_facts": 19,
        "hourly_facts": 9, "alerts": 8, "dim_datas": 23, "locations": 18}


def test_nulls_pass_range_and_value_checks(spark, rows):
    df = frame(spark, [None, -1.0, 0.0, 5.0, 5.1])
    assert rows(dq.accepted_range(df, "v", 0, 5)) == [(-1.0,), (5.1,)]
    assert rows(dq.accepted_range(df, "v", 0, 5, inclusive=False)) == [(-1.0,), (0.0,), (5.0,), (5.1,)]
    assert rows(dq.accepted_range(df, "v", lo=5)) == [(-1.0,), (0.0,)]
    assert rows(dq.accepted_values(df, "v", [0.0, 5.0])) == [(-1.0,), (5.1,)]
    assert rows(dq.not_null(df, "v")) == [(None,)]


def test_range_count_has_no_row_when_clean(spark):
    df = frame(spark, [1.0, 2.0])
    assert dq.accepted_range_count(df, "v", 0, 5).count() == 0
    assert dq.accepted_range_count(df, "v", 2, 5).first().failures == 1


def test_unique_ignores_nulls(spark, rows):
    assert rows(dq.unique(frame(spark, [1.0, 1.0, 2.0, None, None]), "v")) == [(1.0, 2)]


def test_location_freshness_order(spark):
    seed = spark.createDataFrame([(f"l{k}",) for k in range(4)], "location_id string")
    got = dq.stale_locations(seed, loads(spark, 1, 30, 100), F.lit(NOW)).collect()
    assert [(r.location_id, r.age_hours, r.status) for r in got] == [
        ("l3", None, "never_loaded"), ("l2", 100, "stale"), ("l1", 30, "stale")]


@pytest.mark.parametrize("hours, status", [(25, "pass"), (26, "warn"), (49, "warn"), (50, "error"), (None, "error")])
def test_source_freshness(spark, hours, status):
    assert dq.source_freshness({"daily": loads(spark, hours)}, F.lit(NOW)).first().status == status


def test_recent_load_any_and_all(spark):
    tables = {"daily": loads(spark, 1, 2), "hourly": loads(spark, 50)}
    any_ = dq.recent_load(tables, F.lit(NOW), hours=7, mode="any").orderBy("table").collect()
    assert [(r.table, r.total, r.passed) for r in any_] == [("daily", 2, True), ("hourly", 0, True)]
    assert not dq.recent_load(tables, F.lit(NOW), hours=7, mode="all").first().passed
    assert not dq.recent_load(tables, F.lit(NOW), minutes=30, mode="any").first().passed


def test_stored_failures_hold_the_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", -5.0), (None, 9.0)], "k string, v double")
    checks = [dq.Check("t", "k", "not_null"), dq.Check("t", "v", "accepted_range", lo=0, hi=5),
              dq.Check("t", "k", "unique")]
    dq.store_failures({"t": df}, str(tmp_path / "failures"), checks)
    stored = spark.read.parquet(str(tmp_path / "failures"))
    got = sorted((r["check"], r["row"]) for r in stored.collect())
    assert got == [("t.k.not_null", '{"v":9.0}'), ("t.v.accepted_range", '{"k":"b","v":-5.0}'),
                   ("t.v.accepted_range", '{"v":9.0}')]


def test_row_checks_share_one_scan(spark, plan):
    df = frame(spark, [1.0])
    checks = [dq.Check("t", "v", "not_null"), dq.Check("t", "v", "accepted_range", lo=0, hi=5)]
    assert plan(dq.row_checks(df, checks)).count("Scan ") == 1


def counts(spark, **per_location):
    rows = [(name,) for name, n in per_location.items() for _ in range(n)]
    return spark.createDataFrame(rows, "location_id string")


def test_completeness(spark, rows):
    raw = counts(spark, a=5, b=3, c=6)
    assert rows(audit.incomplete(raw, 5)) == [("b", 3, 2)]
    assert rows(audit.mismatched(raw, 5)) == [("b", 3, -2), ("c", 6, 1)]
    assert audit.count_complete(raw, 5).first()[0] == 2
    assert rows(audit.incomplete(raw, audit.fullest(raw))) == [("a", 5, 1), ("b", 3, 3)]
    assert rows(audit.incomplete_since(raw, "2024-01-01", "2024-01-06")) == [("b", 3, 5, 2)]
    assert audit.distinct_locations(raw).first()[0] == 3


def test_summary_counts_raw_and_staged_rows_in_one_scan(spark, plan):
    from pluvio import schemas
    from pluvio.operators.staging import daily_columns

    names = schemas.RAW_DAILY.fieldNames()

    def row(**values):
        return tuple((dict.fromkeys(names) | {"location_id": "a", "date": dt.date(2024, 1, 1), "_extracted_at": NOW, "id": 1} | values)[n] for n in names)

    raw = spark.createDataFrame([
        row(temperature_2m_max=99.0), row(id=2, temperature_2m_max=5.0, uv_index_max=30.0), row(date=None, uv_index_max=30.0),
        row(location_id="b", _extracted_at=NOW - dt.timedelta(hours=3)),
    ], schemas.RAW_DAILY)
    raw_checks = [c for c in dq.CHECKS if c.table == "raw_daily"]
    staged = [c for c in dq.CHECKS if c.table == "stg_daily"]
    summary = dq.load_summary(raw, ["location_id", "date"], daily_columns(), raw_checks, staged)
    assert plan(summary).count("Scan ") == 1
    counted = {r["check"]: r["failures"] for p, c in (("_raw", raw_checks), ("_stg", staged)) for r in dq._summed(summary, c, p).collect()}
    # The row without a date is not staged, and of the repeats only the newest is.
    assert counted["raw_daily.temperature_2m_max.accepted_range"] == 1 and counted["raw_daily.date.not_null"] == 1
    assert counted["raw_daily.uv_index_max.accepted_range"] == 2 and counted["stg_daily.uv_index_max.accepted_range"] == 1
    assert counted["stg_daily.temp_max_c.not_null"] == 1
    by = {r.location_id: r for r in summary.collect()}
    assert by["a"]._extracted_at == NOW and by["b"]._extracted_at == NOW - dt.timedelta(hours=3)


def test_stored_failures_hold_the_singular_checks(spark, tmp_path):
    from pluvio import schemas

    names = schemas.DAILY_FACTS.fieldNames()
    day = dt.date(2024, 1, 1)
    fact = tuple((dict.fromkeys(names) | {"location_id": "l0", "date": day, "temp_min_c": 9.0, "temp_max_c": 1.0, "year_month": "2024-01"})[n] for n in names)
    alert = tuple((dict.fromkeys(schemas.ALERTS.fieldNames()) | {"location_id": "x", "date": day, "year_month": "2024-01"})[n]
                  for n in schemas.ALERTS.fieldNames())
    tables = {
        "daily_facts": spark.createDataFrame([fact], schemas.DAILY_FACTS), "alerts": spark.createDataFrame([alert], schemas.ALERTS),
        "locations": spark.createDataFrame([("l0",)], "location_id string"), "raw_daily": loads(spark, 100),
    }
    checks = [dq.Check("daily_facts", "location_id", "not_null")]
    dq.store_failures(tables, str(tmp_path / "failures"), checks, now=F.lit(NOW), as_of=day)
    stored = spark.read.parquet(str(tmp_path / "failures"))
    assert {r["check"] for r in stored.collect()} == {"temp_min_less_than_max", "alerts_have_valid_location", "raw_data_freshness"}
