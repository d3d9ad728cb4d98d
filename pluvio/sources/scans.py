"""Scans with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from pluvio import schemas
from pluvio.functions.values import iso_text


def read_raw_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_DAILY).parquet(path)


def read_raw_hourly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_HOURLY).parquet(path)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """The locations seed, a CSV with a header."""
    return spark.read.schema(schemas.LOCATIONS).csv(path, header=True, enforceSchema=False)


def read_mart(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A partitioned mart, columns in declared order. The schema also fixes the partition column's type."""
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path).select(schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_increment(source: DataFrame, target: DataFrame | None, mark: str = "_extracted_at") -> DataFrame:
    """Source rows loaded after the target's newest row; every row when the target is absent or empty.

    The newest mark is a scalar subquery: evaluated once, then pushed to the source scan as a
    plain ``mark > value`` filter. ``mark`` is never null in a raw table.
    """
    if target is None:
        return source
    start = F.lit("0001-01-01").cast(source.schema[mark].dataType)
    newest: Column = target.agg(F.coalesce(F.max(mark), start)).scalar()
    return source.filter(F.col(mark) > newest)


def read_jdbc_increment(
    spark: SparkSession, url: str, table: str, target: DataFrame | None, *, key: str = "id", bounds: tuple[int, int],
    partitions: int, mark: str = "_extracted_at", properties: dict[str, str] | None = None,
) -> DataFrame:
    """The same increment from a relational source, read in ``partitions`` ranges of ``key``."""
    newest = None if target is None else target.agg(F.max(mark)).first()[0]
    source = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                 numPartitions=str(partitions), **(properties or {}))
        .load()
    )
    return source if newest is None else source.filter(F.col(mark) > F.lit(newest))


def to_warehouse_types(df: DataFrame) -> DataFrame:
    """Decimals become doubles, dates and timestamps ISO text; other columns stay."""
    def convert(name: str, kind: str) -> Column:
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind == "date":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        if kind.startswith("timestamp"):
            return iso_text(F.col(name)).alias(name)
        return F.col(name)

    return df.select([convert(name, kind) for name, kind in df.dtypes])
