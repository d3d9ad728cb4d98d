"""Numbers, keys and timestamp text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.functions import lit


def rounded(value: Column, digits: int) -> Column:
    """Half away from zero, decided on six decimal places rather than on binary doubles."""
    return F.round(value.cast("decimal(18,6)"), digits).cast("double")


def rounded_sum(value: Column, digits: int) -> Column:
    """``rounded`` for sums, which may pass the twelve integer digits kept for single readings."""
    return F.round(value.cast("decimal(38,6)"), digits).cast("double")


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts as text joined by '-'; a null part counts as ``_null_``."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), lit("_null_")) for p in parts]))


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def norm_ts(text: Column) -> Column:
    """ISO text of a reading time: minutes get ``:00`` seconds, ``T`` becomes a space."""
    full = F.when(F.length(text) == 16, F.concat(text, lit(":00"))).otherwise(text)
    return F.replace(full, lit("T"), lit(" "))


def iso_text(ts: Column) -> Column:
    """ISO 8601 text of a timestamp; microseconds only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, lit("."), micros))


def load_status(last_load: Column, now: Column, limit_hours: int = 25) -> tuple[Column, Column]:
    """(whole hours since the last load, never_loaded / stale / fresh)."""
    age = F.timestamp_diff("HOUR", last_load, now)
    status = F.when(last_load.isNull(), "never_loaded").when(age > limit_hours, "stale").otherwise("fresh")
    return age, status
