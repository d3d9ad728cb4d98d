"""API payloads: one JSON object per request, holding parallel arrays.

Array elements are read as text and converted one by one, so an element that does not fit its type is null
alone. What cannot be read at all is not lost: ``rejects`` returns it with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pluvio import schemas
from pluvio.functions.values import norm_ts


def _payload_schema(block: str, head: list[str], variables: T.StructType) -> T.StructType:
    arrays = [T.StructField(name, T.ArrayType(T.StringType())) for name in ["time", *variables.names]]
    heads = [T.StructField(h, T.StringType()) for h in head]
    return T.StructType([*heads, T.StructField(block, T.StructType(arrays)), T.StructField("_corrupt", T.StringType())])


def _parsed(payloads: DataFrame, block: str, head: list[str], variables: T.StructType) -> DataFrame:
    schema = _payload_schema(block, head, variables)
    return payloads.withColumn("p", F.from_json("payload", schema, {"columnNameOfCorruptRecord": "_corrupt"}))


def _value(text: Column, kind: T.DataType) -> Column:
    """One element of an array; null where it does not fit. A whole number may be written with a fraction of zero."""
    if isinstance(kind, T.TimestampType):
        return _time(text, kind)
    if isinstance(kind, T.IntegralType):
        number = text.try_cast("double")
        return F.when(number == F.floor(number), number).try_cast(kind)
    return text.try_cast(kind)


def _time(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return text.try_cast("date")
    return F.try_to_timestamp(norm_ts(text))


def _flatten(payloads: DataFrame, block: str, head: list[str], key: T.StructField,
             variables: T.StructType) -> DataFrame:
    parsed = _parsed(payloads, block, head, variables)
    rows = parsed.select("location_id", "_extracted_at", "p", F.posexplode(f"p.{block}.time").alias("i", "t"))

    def variable(field: T.StructField) -> Column:
        # get() gives null past the end of a short array and for an absent variable.
        return _value(F.get(F.col(f"p.{block}.{field.name}"), F.col("i")), field.dataType).alias(field.name)

    return rows.select(
        "location_id",
        _time(F.col("t"), key.dataType).alias(key.name),
        *[F.col(f"p.{h}").try_cast("string" if h == "timezone" else "double").alias(h) for h in head],
        *[variable(f) for f in variables],
        "_extracted_at",
    )


def flatten_daily(payloads: DataFrame) -> DataFrame:
    """(location_id, payload, _extracted_at) -> one row per location and date."""
    key = schemas.RAW_DAILY["date"]
    return _flatten(payloads, "daily", ["latitude", "longitude"], key, schemas.DAILY_VARIABLES)


def flatten_hourly(payloads: DataFrame) -> DataFrame:
    """(location_id, payload, _extracted_at) -> one row per location and hour."""
    key = schemas.RAW_HOURLY["timestamp"]
    head = ["latitude", "longitude", "elevation", "timezone"]
    return _flatten(payloads, "hourly", head, key, schemas.HOURLY_VARIABLES)


def rejects(payloads: DataFrame, block: str = "daily") -> DataFrame:
    """(location_id, payload, _extracted_at, reason) of the payloads that give no rows.

    Reasons: ``malformed`` (no JSON object), ``no_times`` (no time array, or an empty one).
    """
    parsed = _parsed(payloads, block, [], T.StructType())
    malformed = F.col("payload").isNull() | F.col("p").isNull() | F.col("p._corrupt").isNotNull()
    no_times = F.coalesce(F.size(F.col(f"p.{block}.time")), F.lit(0)) <= 0
    reason = F.when(malformed, "malformed").when(no_times, "no_times")
    return parsed.select("location_id", "payload", "_extracted_at", reason.alias("reason")).filter("reason is not null")


def _pack(df: DataFrame, block: str, head: list[str], key: str, key_text: Column, span: Column,
          variables: T.StructType) -> DataFrame:
    def wire(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(field.name, "yyyy-MM-dd'T'HH:mm").alias(field.name)
        # Services write whole numbers as 55 or as 55.0.
        return F.col(field.name).cast("double").alias(field.name) if isinstance(field.dataType, T.IntegralType) else F.col(field.name)

    row = F.struct(F.col(key).alias("_key"), key_text.alias("time"), *[wire(f) for f in variables])
    grouped = df.groupBy("location_id", span.alias("span")).agg(
        *[F.max(h).alias(h) for h in head],
        F.max("_extracted_at").alias("_extracted_at"),
        F.sort_array(F.collect_list(row)).alias("rows"),
    )
    arrays = F.struct(*[F.col(f"rows.{name}").alias(name) for name in ["time", *variables.names]])
    return grouped.select(
        "location_id", F.to_json(F.struct(*head, arrays.alias(block))).alias("payload"), "_extracted_at"
    )


def pack_daily(raw: DataFrame) -> DataFrame:
    """Deduplicated daily readings -> one payload per location and month, at most 31 entries each."""
    text = F.date_format("date", "yyyy-MM-dd")
    return _pack(raw, "daily", ["latitude", "longitude"], "date", text, F.date_format("date", "yyyy-MM"),
                 schemas.DAILY_VARIABLES)


def pack_hourly(raw: DataFrame) -> DataFrame:
    """Deduplicated hourly readings -> one payload per location and date, at most 24 entries each."""
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm")
    return _pack(raw, "hourly", ["latitude", "longitude", "elevation", "timezone"], "timestamp", text,
                 F.to_date("timestamp"), schemas.HOURLY_VARIABLES)
