"""Completeness counts over the raw tables, or over the load ledgers that stored ones keep (see ``sources.versions``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pluvio.operators.filters import as_date, last_n_days


def _total(raw: DataFrame) -> Column:
    """The number of raw rows, which a ledger has summed up in ``rows``."""
    return (F.coalesce(F.sum("rows"), F.lit(0)) if "rows" in raw.columns else F.count(F.lit(1))).alias("total")


def row_counts(**tables: DataFrame) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table"), _total(df)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def distinct_locations(raw: DataFrame) -> DataFrame:
    return raw.agg(F.countDistinct("location_id").alias("municipios_coletados"))


def rows_per_location(raw: DataFrame) -> DataFrame:
    return _counted(raw).orderBy("location_id")


def _counted(raw: DataFrame) -> DataFrame:
    return raw.groupBy("location_id").agg(_total(raw))


def fullest(raw: DataFrame) -> Column:
    """Rows of the location that has most: the expected count when none is known."""
    return _counted(raw).agg(F.max("total")).scalar()


def _expected(expected) -> Column:
    return (expected if isinstance(expected, Column) else F.lit(expected)).cast("long")


def incomplete(raw: DataFrame, expected, collected: str = "total_coletado", missing: str = "dias_faltando",
               expected_as: str | None = None) -> DataFrame:
    """Locations below the expected count, largest shortfall first."""
    target, short = _expected(expected), _expected(expected) - F.col("total")
    columns = ["location_id", F.col("total").alias(collected)]
    if expected_as:
        columns.append(target.alias(expected_as))
    below = _counted(raw).filter(F.col("total") < target)
    return below.select(*columns, short.alias(missing)).orderBy(F.desc(missing), "location_id")


def mismatched(raw: DataFrame, expected) -> DataFrame:
    """Locations whose count differs, with the signed difference."""
    gap = F.col("total") - _expected(expected)
    return _counted(raw).withColumn("diferenca", gap).filter("diferenca <> 0").orderBy("diferenca", "location_id")


def incomplete_since(raw: DataFrame, start, as_of) -> DataFrame:
    """Expected count: every day from ``start`` to the day before ``as_of``."""
    days = F.date_diff(F.date_sub(as_date(as_of), 1), as_date(start)) + 1
    return incomplete(raw, days, "dias_coletados", "dias_faltando", "dias_esperados")


def count_complete(raw: DataFrame, expected) -> DataFrame:
    """Locations with at least the expected count.

    The locations to look for come from the same table, so the semi join with itself is
    just the number of full groups: one scan.
    """
    complete = _counted(raw).filter(F.col("total") >= _expected(expected)).dropna(subset=["location_id"])
    return complete.agg(F.count("location_id").alias("municipios_completos"))


def date_gaps(daily: DataFrame, n: int = 30, as_of=None) -> DataFrame:
    """Runs of missing days inside the last ``n`` days; at most n + 1 rows per location reach the window."""
    series = Window.partitionBy("location_id").orderBy("date")
    steps = last_n_days(daily, n, as_of).select(
        "location_id", F.lag("date").over(series).alias("gap_start"), F.col("date").alias("gap_end")
    )
    return (
        steps.withColumn("gap_days", F.date_diff("gap_end", "gap_start"))
        .filter("gap_days > 1")
        .orderBy("location_id", "gap_start")
    )
