"""What the daily marts carry from month to month, so that a load need not look back into the facts.

For every month and location the window state tells the last readings before that month, as many as the rolling means
reach back: their number, the date of the first, and those of them that lie in the month just before. The others are in the states before it,
so each reading is stored once, however few a month has. States go on through months without readings (and then keep the newest one), up to the month after
the newest reading (the horizon). The states at the horizon tell each location's newest reading; what the map shows of it is kept as a table of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pluvio.config import ROLLING_ROWS
from pluvio.operators.joins import small_side

STATE_ROWS = ROLLING_ROWS - 1
# Of a reading: what the rolling means and the map need.
CARRIED = ["date", "temp_max_c", "temp_avg_c", "precipitation_mm"]
LATEST_GEO = ["city_name", "mesoregion", "latitude", "longitude"]


def horizon_of(newest: Column) -> Column:
    return F.add_months(F.trunc(newest, "month"), 1)


def window_states(series: DataFrame, horizon: Column, key: Sequence[str] = ("location_id",)) -> DataFrame:
    """The states of all months after a reading up to ``horizon``, by ``key``; ``series`` is unique by key and date."""
    by_date = Window.partitionBy(*key).orderBy("date")
    month = F.trunc("date", "month")
    held = series.select(
        *key, month.alias("_month"), F.struct(*CARRIED).alias("_reading"),
        F.least(F.row_number().over(by_date), F.lit(STATE_ROWS)).alias("_n"),
        # The first of the last readings: the location's own first one as long as it has fewer.
        F.coalesce(F.lag("date", STATE_ROWS - 1).over(by_date), F.first("date").over(by_date)).alias("_first"),
        F.coalesce(F.trunc(F.lead("date").over(by_date), "month"), horizon).alias("_until"),
    )
    # A month has at most 31 readings of a key.
    of_month = held.groupBy(*key, "_month").agg(
        F.sort_array(F.collect_list("_reading")).alias("_readings"), F.max("_n").alias("n"), F.max("_first").alias("first"), F.max("_until").alias("_until")
    )
    own = F.slice("_readings", F.greatest(F.size("_readings") - (STATE_ROWS - 1), F.lit(1)), STATE_ROWS)
    months = F.sequence(F.add_months("_month", 1), F.col("_until"), F.expr("interval 1 month"))
    return of_month.filter(F.col("_month") < F.col("_until")).select("*", F.posexplode(months).alias("_at", "_before")).select(
        *key, "n", "first", F.when(F.col("_at") == 0, own).otherwise(F.slice("_readings", 1, 0)).alias("readings"),
        F.when(F.col("_at") > 0, F.element_at("_readings", -1)).alias("last"), F.date_format("_before", "yyyy-MM").alias("before"),
    )


def newest_of_state() -> Column:
    """The newest reading that a state tells."""
    return F.coalesce(F.get("readings", F.size("readings") - 1), F.col("last"))


def readings_before(states: DataFrame, starts: DataFrame) -> DataFrame:
    """The readings that the states of (location_id, before, start) in ``starts`` tell, a row each: each from the state after its month."""
    wanted = states.join(starts, ["location_id", "before"]).select("location_id", "start", F.col("before").alias("_to"), "first")
    # Not left to the size as stored, where the readings take little: neither side is broadcast unless it is measured to be small.
    held = states.filter(F.size("readings") > 0).select("location_id", "before", "readings").hint("merge").join(wanted, "location_id")
    held = held.filter((F.col("before") > F.date_format("first", "yyyy-MM")) & (F.col("before") <= F.col("_to")))
    each = held.select("location_id", "start", "first", F.explode("readings").alias("_r"))
    return each.filter(F.col("_r.date") >= F.col("first")).select("location_id", "start", "_r.*")


def latest_readings(states: DataFrame, loc: DataFrame) -> DataFrame:
    """Each location's newest reading with the seed's geography, from the states at the horizon."""
    last = states.select("location_id", newest_of_state().alias("_r")).select("location_id", "_r.*")
    return last.join(small_side(loc.select("location_id", *LATEST_GEO)), "location_id", "left").select(
        "location_id", *LATEST_GEO, "date", "temp_max_c", "precipitation_mm"
    )
