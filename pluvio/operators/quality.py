"""Data-quality checks: each operator returns the violating rows, the suite one row per check."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from pluvio.functions.calendar import MONTHS_PT, SEASONS_PT, WEEKDAYS_PT
from pluvio.functions.values import load_status
from pluvio.operators.audit import date_gaps
from pluvio.operators.joins import latest_load, orphan_alerts
from pluvio.operators.staging import daily_columns, hourly_columns
from pluvio.plans.models import dim_dates
from pluvio.session import file_system, write_parquet


# --- single checks -----------------------------------------------------------------------------


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Repeated values with their count; nulls are not compared."""
    counted = df.select(col).dropna().groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter("n_records > 1")


def outside_values(col: str, values: Sequence) -> Column:
    return ~F.col(col).isin(list(values))


def outside_range(col: str, lo=None, hi=None, inclusive: bool = True) -> Column:
    """Null readings are not outside."""
    c, bad = F.col(col), F.lit(False)
    if lo is not None:
        bad = bad | ((c < lo) if inclusive else (c <= lo))
    if hi is not None:
        bad = bad | ((c > hi) if inclusive else (c >= hi))
    return bad


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(outside_values(col, values))


def accepted_range(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    return df.filter(outside_range(col, lo, hi, inclusive))


def accepted_range_count(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """The number of failures; no row when there are none."""
    return accepted_range(df, col, lo, hi).agg(F.count(F.lit(1)).alias("failures")).filter("failures > 0")


def min_le_max(daily: DataFrame) -> DataFrame:
    wrong = daily.filter(F.col("temp_min_c") > F.col("temp_max_c"))
    return wrong.select("location_id", "date", "temp_min_c", "temp_max_c")


def unique_pk(df: DataFrame, keys: Sequence[str] = ("location_id", "date")) -> DataFrame:
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")
    return repeated.orderBy(F.desc("occurrences"), *keys)


def stale_locations(loc: DataFrame, raw: DataFrame, now: Column, limit_hours: int = 25) -> DataFrame:
    """Seed locations never loaded, or last loaded more than ``limit_hours`` before ``now``."""
    age, status = load_status(F.col("latest_extracted_at"), now, limit_hours)
    loads = latest_load(loc, raw).withColumns({"age_hours": age, "status": status})
    return loads.filter("status <> 'fresh'").orderBy(F.desc_nulls_first("age_hours"), "location_id")


def source_freshness(tables: dict[str, DataFrame], now: Column, warn: int = 25, error: int = 49) -> DataFrame:
    """pass / warn / error per source table by the age of its newest row."""

    def state(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("table"), F.max("_extracted_at").alias("max_loaded_at"))

    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    # A table without any load time has no fresh row to show.
    status = F.when(age.isNull() | (age > error * 3600), "error").when(age > warn * 3600, "warn").otherwise("pass")
    states = reduce(DataFrame.unionByName, [state(name, df) for name, df in tables.items()])
    return states.withColumn("status", status)


def recent_load(tables: dict[str, DataFrame], now: Column, *, minutes: int = 0, hours: int = 0,
                mode: str = "any") -> DataFrame:
    """Rows loaded in the last minutes/hours per table.

    ``mode='any'`` passes when one table has some, ``mode='all'`` only when each has.
    """
    since = F.timestamp_add("MINUTE", F.lit(-(minutes + 60 * hours)), now)

    def loaded(name: str, df: DataFrame) -> DataFrame:
        fresh = df.filter(F.col("_extracted_at") >= since)
        return fresh.agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("total"), F.max("_extracted_at").alias("last_load")
        )

    counts = reduce(DataFrame.unionByName, [loaded(name, df) for name, df in tables.items()])
    # One row per table reaches this window.
    decisive = F.max("total") if mode == "any" else F.min("total")
    return counts.withColumn("passed", decisive.over(Window.partitionBy(F.lit(0))) > 0)


# --- the declared suite ------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str  # not_null, unique, accepted_values, accepted_range
    values: tuple = field(default=())
    lo: float | None = None
    hi: float | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}.{self.kind}"

    def violated(self) -> Column:
        """The row-level condition; ``unique`` has none."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return outside_values(self.column, self.values)
        return outside_range(self.column, self.lo, self.hi)


def _nulls(table: str, columns: str) -> list[Check]:
    return [Check(table, c, "not_null") for c in columns.split()]


def _ranges(table: str, **bounds: tuple[float, float]) -> list[Check]:
    return [Check(table, c, "accepted_range", lo=lo, hi=hi) for c, (lo, hi) in bounds.items()]


def _lists(table: str, **values: Iterable[str]) -> list[Check]:
    return [Check(table, c, "accepted_values", tuple(v)) for c, v in values.items()]


# The checks declared for each table.
CHECKS: list[Check] = [
    *_nulls("raw_hourly", "location_id timestamp _extracted_at"),
    *_ranges("raw_hourly", temperature_2m=(-20, 55), relative_humidity_2m=(0, 100), precipitation=(0, 200),
             wind_speed_10m=(0, 300)),
    *_nulls("raw_daily", "location_id date _extracted_at"),
    *_ranges("raw_daily", temperature_2m_max=(-20, 60), temperature_2m_min=(-30, 55), precipitation_sum=(0, 500),
             uv_index_max=(0, 20)),
    *_nulls("stg_daily", "location_id date temp_max_c temp_min_c temp_avg_c _extracted_at _loaded_at"),
    *_ranges("stg_daily", precipitation_mm=(0, 500), uv_index_max=(0, 20)),
    *_nulls("stg_hourly", "location_id observed_at latitude longitude _extracted_at _loaded_at"),
    *_ranges("stg_hourly", latitude=(-35, 5), longitude=(-75, -30), temperature_c=(-20, 55),
             relative_humidity_pct=(0, 100), precipitation_mm=(0, 200), wind_direction_deg=(0, 360)),
    *_nulls("int_daily", "location_id date city_name"),
    *_nulls("daily_facts", "surrogate_key date location_id city_name year temp_max_c precipitation_class "
                           "_dbt_updated_at"),
    Check("daily_facts", "surrogate_key", "unique"),
    *_ranges("daily_facts", month=(1, 12), temp_max_c=(-20, 60), temp_min_c=(-30, 55), temp_amplitude_c=(0, 40),
             temp_anomaly_c=(-25, 25), precipitation_mm=(0, 500), uv_index_max=(0, 20), daylight_hours=(10, 14)),
    *_lists("daily_facts", precipitation_class=["dry", "light", "moderate", "heavy", "extreme"],
            uv_risk_level=["low", "moderate", "high", "very_high", "extreme"]),
    *_nulls("hourly_facts", "surrogate_key observed_at date hour location_id city_name _dbt_updated_at"),
    Check("hourly_facts", "surrogate_key", "unique"),
    *_ranges("hourly_facts", hour=(0, 23)),
    *_nulls("alerts", "surrogate_key date location_id alert_type severity"),
    Check("alerts", "surrogate_key", "unique"),
    *_lists("alerts", alert_type=["extreme_heat", "frost", "heavy_rain", "high_winds", "extreme_uv", "heat_anomaly",
                                  "cold_anomaly", "precip_anomaly"],
            severity=["critical", "high", "medium", "low"]),
    *_nulls("dim_datas", "dt_data ano mes dia trimestre nm_mes nm_mes_abrev nm_dia_semana estacao ano_mes "
                         "nm_trimestre sigla_trimestre fl_fim_de_semana primeiro_dia_mes ultimo_dia_mes"),
    Check("dim_datas", "dt_data", "unique"),
    *_ranges("dim_datas", mes=(1, 12), trimestre=(1, 4), dia_semana_num=(0, 6)),
    *_lists("dim_datas", nm_mes=MONTHS_PT, nm_dia_semana=WEEKDAYS_PT, estacao=SEASONS_PT,
            sigla_trimestre=["Q1", "Q2", "Q3", "Q4"]),
    *_nulls("locations", "location_id city_name state_name state_code country region mesoregion latitude longitude"),
    Check("locations", "location_id", "unique"),
    *_lists("locations", state_name=["Santa Catarina"], state_code=["SC"], country=["Brasil"], region=["Sul"],
            mesoregion=["Grande Florianópolis", "Norte Catarinense", "Vale do Itajaí", "Serrana",
                        "Oeste Catarinense", "Sul Catarinense"],
            population_class=["small", "medium", "large", "metropolitan"]),
    *_ranges("locations", latitude=(-30, -26), longitude=(-54, -48)),
]

SINGULAR_CHECKS = {
    "temp_min_less_than_max": "daily_facts",
    "unique_daily_facts_pk": "daily_facts",
    "no_date_gaps_per_location": "daily_facts",
    "alerts_have_valid_location": "alerts",
    "raw_data_freshness": "raw_daily",
}


def result(df: DataFrame, check: str, table: str, column: str, kind: str, severity: str) -> DataFrame:
    head = {"check": check, "table": table, "column": column, "kind": kind}
    return df.select(*[F.lit(v).alias(k) for k, v in head.items()], "failures", F.lit(severity).alias("severity"))


def row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks of a table in one pass: a counter each, then one row per counter."""
    return one_row_each(df.agg(*[F.count_if(c.violated()).alias(f"f{i}") for i, c in enumerate(checks)]), checks)


def one_row_each(counters: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The counters f0, f1, ... of one row as one row per check."""
    rows = [
        F.struct(
            F.lit(c.name).alias("check"), F.lit(c.table).alias("table"), F.lit(c.column).alias("column"),
            F.lit(c.kind).alias("kind"), F.col(f"f{i}").alias("failures"), F.lit(c.severity).alias("severity"),
        )
        for i, c in enumerate(checks)
    ]
    return counters.select(F.inline(F.array(*rows)))


def _unique_check(df: DataFrame, c: Check) -> DataFrame:
    failures = unique(df, c.column).agg(F.count(F.lit(1)).alias("failures"))
    return result(failures, c.name, c.table, c.column, c.kind, c.severity)


def singular_violations(tables: dict[str, DataFrame], now: Column, as_of=None) -> dict[str, DataFrame]:
    """The violating rows of each check that spans columns or tables."""
    daily, alerts, loc, raw = (tables[t] for t in ("daily_facts", "alerts", "locations", "raw_daily"))
    return {
        "temp_min_less_than_max": min_le_max(daily),
        "unique_daily_facts_pk": unique_pk(daily),
        "no_date_gaps_per_location": date_gaps(daily, as_of=as_of),
        "alerts_have_valid_location": orphan_alerts(alerts, loc),
        "raw_data_freshness": stale_locations(loc, raw, now),
    }


def load_summary(raw: DataFrame, keys: Sequence[str], columns: Sequence[Column], raw_checks: Sequence[Check],
                 staged_checks: Sequence[Check], order: Sequence[str] = ("_extracted_at", "id"), by: Sequence[Column] = ()) -> DataFrame:
    """A row per location (and ``by``, from the keys under a leading ``_``): rows, failures of the row-level checks on the raw and on the staged rows, newest load, date span.

    One scan and one exchange of the raw table: its rows are combined by key before the exchange, which counts their
    failures and picks the newest row, so a key of many repeats is no hot spot. Rows are staged by ``columns`` where they are read, and of
    the staged row only which checks it fails is shuffled, a bit each.
    """
    time, names = keys[-1], [f"_{k}" for k in keys]
    failed = [c.violated().alias(f"_raw{i}") for i, c in enumerate(raw_checks)]
    order_of = F.struct(*[F.col(c) for c in order]).alias("_order")
    staged = raw.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_extracted_at").alias("_newest"), order_of, *failed, *columns)
    bits = [F.when(c.violated(), F.lit(1 << i % 60)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(staged_checks)]
    masks = F.array(*[reduce(Column.bitwiseOR, bits[at : at + 60], F.lit(0).cast("long")) for at in range(0, len(bits) or 1, 60)])
    by_key = staged.groupBy(*names).agg(
        *[F.count_if(f"_raw{i}").alias(f"_raw{i}") for i in range(len(raw_checks))],
        F.count(F.lit(1)).alias("_n"), F.max("_newest").alias("_newest"), F.max_by(masks, "_order").alias("_failed"),
    )
    # Rows without one of the keys are not staged.
    present = reduce(and_, [F.col(n).isNotNull() for n in names])
    fails = [F.col("_failed")[i // 60].bitwiseAND(F.lit(1 << i % 60)) != 0 for i in range(len(staged_checks))]
    return by_key.groupBy(F.col("_location_id").alias("location_id"), *by).agg(
        *[F.sum(f"_raw{i}").alias(f"_raw{i}") for i in range(len(raw_checks))], F.sum("_n").alias("total"),
        *[F.count_if(present & f).alias(f"_stg{i}") for i, f in enumerate(fails)],
        F.max("_newest").alias("_extracted_at"), F.min(f"_{time}").alias("first"), F.max(f"_{time}").alias("last"),
    )


def _summed(summary: DataFrame, checks: Sequence[Check], prefix: str) -> DataFrame:
    totals = summary.agg(*[F.coalesce(F.sum(f"{prefix}{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(checks))])
    return one_row_each(totals, checks)


def run_suite(tables: dict[str, DataFrame], store: Callable[[DataFrame, str], DataFrame], now: Column | None = None,
              checks: Sequence[Check] = tuple(CHECKS), as_of=None) -> DataFrame:
    """One row per check: failures, severity and pass/fail status.

    ``tables`` holds raw_daily, raw_hourly, daily_facts, hourly_facts, alerts and locations. ``store`` writes a frame under a name and
    reads it back: each raw table is scanned once, for a summary by location, from which its own checks, those of its staging
    model, the load times and the calendar's bounds are read. ``int_daily`` is checked on the stored facts, which hold its rows.
    ``now`` is the newest load of the daily table by default.
    """
    own = {t: [c for c in checks if c.table == t and c.kind != "unique"] for t in dict.fromkeys(c.table for c in checks)}
    daily, hourly = (
        store(load_summary(tables[raw], ["location_id", time], columns, own.get(raw, []), own.get(staged, [])), f"{raw}-summary")
        for raw, staged, time, columns in (
            ("raw_daily", "stg_daily", "date", daily_columns()), ("raw_hourly", "stg_hourly", "timestamp", hourly_columns()))
    )
    now = daily.agg(F.max("_extracted_at")).scalar() if now is None else now
    bounds = (daily.agg(f(c)).scalar() for f, c in ((F.min, "first"), (F.max, "last")))
    facts = tables["daily_facts"]
    frames = {"int_daily": facts, "dim_datas": dim_dates(facts.sparkSession, *bounds)} | tables
    parts = []
    for table, row_level in own.items():
        if row_level and table in ("raw_daily", "raw_hourly", "stg_daily", "stg_hourly"):
            summary = daily if table.endswith("daily") else hourly
            parts.append(_summed(summary, row_level, "_raw" if table.startswith("raw") else "_stg"))
        elif row_level:
            parts.append(row_checks(frames[table], row_level))
        parts += [_unique_check(frames[table], c) for c in checks if c.table == table and c.kind == "unique"]
    for name, rows in singular_violations(frames | {"raw_daily": daily}, now, as_of).items():
        failures = rows.agg(F.count(F.lit(1)).alias("failures"))
        parts.append(result(failures, name, SINGULAR_CHECKS[name], "", "singular", "error"))
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def failing_rows(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, row as JSON) of every row-level violation of one table, found in one pass."""
    names = F.array_compact(F.array(*[F.when(c.violated(), c.name) for c in checks if c.kind != "unique"]))
    return table.select(F.explode(names).alias("check"), F.to_json(F.struct(*table.columns)).alias("row"))


def store_failures(tables: dict[str, DataFrame], path: str, checks: Sequence[Check] = tuple(CHECKS),
                   now: Column | None = None, as_of=None) -> None:
    """Save violating rows, a folder per check. Rebalancing splits a hot check over several tasks and files.

    With ``now`` also those of the checks that span columns or tables. Tables are checked one after another, so that only one has its
    rows shuffled at a time; what was saved before gives way when all is written.
    """
    parts = [
        [failing_rows(df, [c for c in checks if c.table == name])]
        for name, df in tables.items()
        if any(c.table == name and c.kind != "unique" for c in checks)
    ]
    across = [
        unique(tables[c.table], c.column).select(F.lit(c.name).alias("check"), F.to_json(F.struct("*")).alias("row"))
        for c in checks
        if c.kind == "unique" and c.table in tables
    ]
    singular = {} if now is None else singular_violations(tables, now, as_of)
    across += [rows.select(F.lit(name).alias("check"), F.to_json(F.struct("*")).alias("row")) for name, rows in singular.items()]
    staging = f"{path}-{uuid.uuid4().hex}"
    for part in [*parts, *([across] if across else [])]:
        write_parquet(reduce(DataFrame.unionByName, part).hint("rebalance", F.col("check")), staging, "check", "append")
    spark = next(iter(tables.values())).sparkSession
    files, old = file_system(spark, path)
    files.delete(old, True)
    if not files.rename(file_system(spark, staging)[1], old):
        raise OSError(f"{staging} could not be moved to {path}")
