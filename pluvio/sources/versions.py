"""Stored tables whose loads become visible at once: versioned folders behind a view.

A table is a view over its current version. A version is an external table, partitioned by load and by the day or
month of its rows, whose partitions are the folders ``load=<id>/<partition>=<value>`` that hold them. A load writes the
folders that it touches under its own id, registers a version of these and of all untouched folders of the current one, and
then points the view there, in one statement of the catalog. So a load is seen entire or not at all: a read begun before goes
on with the old folders, and a run cut short before that statement leaves the old table. The version before the current one is
kept for such reads; what neither of the two uses (older versions, runs cut short) is removed by the next load. One load at a
time may write a table. The catalog holds which version counts, so it must outlive the session where the table shall.

Beside its folders each load leaves its entries of the table's ledger: how many rows of each location a folder holds and when the
newest of them was loaded. A folder never changes once written, so the ledger of a version is the entries of its folders, right after every kind
of load; counts and freshness come from it without a look at the rows.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from pluvio.config import HOT_ROWS, ROWS_PER_FILE
from pluvio.operators.filters import as_date
from pluvio.operators.staging import dedup_latest
from pluvio.session import write_parquet
from pluvio.sources import sinks

# Partitions named in one statement.
_STATEMENT_PARTITIONS = 400
_VERSION, _PREVIOUS = "pluvio.version", "pluvio.previous"
_LEDGER = "_ledger"


@dataclass(frozen=True)
class VersionedTable:
    """The table ``name`` (a view in the catalog) with its folders under ``root``.

    ``partition`` names the column with the first day of the ``unit`` that holds the date or time ``day_of``; the unit is fixed for good.
    Rows of a folder are sorted by ``cluster``. The ledger counts rows by ``counted`` and keeps the newest ``mark``.
    """

    spark: SparkSession
    name: str
    root: str
    schema: StructType
    day_of: str
    cluster: Sequence[str]
    partition: str = "month"
    unit: str = "month"
    counted: str = "location_id"
    mark: str = "_extracted_at"

    def __post_init__(self) -> None:
        if self.day_of not in self.schema.fieldNames():
            raise ValueError(f"the table has no column {self.day_of}")

    @property
    def stored_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(self.partition, DateType())])

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        return self.stored().select(self.schema.fieldNames())

    def stored(self) -> DataFrame:
        """The rows with their partition column, whose filters prune folders."""
        if not self.exists():
            return self.spark.createDataFrame([], self.stored_schema)
        return self.spark.table(self.name)

    def between(self, first, last) -> DataFrame:
        """The rows of the days ``[first, last]``; other folders are not read."""
        day = F.col(self.day_of).cast("date")
        folders = F.col(self.partition).between(self.unit_of(first), self.unit_of(last))
        return self.stored().filter(folders & day.between(as_date(first), as_date(last))).select(self.schema.fieldNames())

    def changes(self, keys: Sequence[str]) -> DataFrame:
        """Keys of the rows that the last load added, changed or removed: what differs between the two versions, in the folders where these differ."""
        columns, sides = self.schema.fieldNames(), []
        if self.exists():
            now, before = ((set(), None) if v is None else (_folders(self.spark, v), v) for v in (self._property(_VERSION), self._property(_PREVIOUS)))
            touched = sorted({dt.date.fromisoformat(value) for value, _ in now[0] ^ before[0]})
            for (_, version), sign in ((now, 1), (before, -1)):
                if version is not None:
                    rows = self.spark.table(version).filter(F.col(self.partition).isin(touched))
                    sides.append(rows.select(*columns, F.lit(sign).alias("_sign")))
        if not sides:
            return self.rows().select(*keys)
        differ = reduce(DataFrame.unionByName, sides).groupBy(columns).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")
        return differ.select(*keys).distinct()

    def unit_of(self, day) -> Column:
        return F.date_trunc(self.unit, as_date(day)).cast("date")

    def folders(self) -> set[tuple[str, str]]:
        """(partition value, load) of each folder; values are days or months, and loads besides the first of a value come by appending."""
        return _folders(self.spark, self._property(_VERSION)) if self.exists() else set()

    def partitions(self) -> set[str]:
        return {value for value, _ in self.folders()}

    def ledger(self) -> DataFrame:
        """The partition, location, number of ``rows`` and newest load of every folder's locations; no row of the table is read."""
        fields = [StructField(self.partition, DateType()), self.schema[self.counted], StructField("rows", LongType()), self.schema[self.mark]]
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], StructType(fields))
        schema = StructType([*fields, StructField("load", StringType())])
        entries = self.spark.read.schema(schema).option("basePath", f"{self.root}/{_LEDGER}").parquet(
            *sorted({f"{self.root}/{_LEDGER}/load={load}" for _, load in folders})
        )
        live = self.spark.createDataFrame(sorted(folders), "value string, of string")
        live = live.select(F.col("value").cast("date").alias("_value"), F.col("of").alias("_load"))
        kept = entries.join(F.broadcast(live), (F.col(self.partition) == F.col("_value")) & (F.col("load") == F.col("_load")), "left_semi")
        return kept.select([f.name for f in fields])

    def _property(self, key: str) -> str | None:
        """The version that the view names. Only its load is kept there: a table's name might look like a secret, which Spark would hide."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        load = {r["key"]: r["value"] for r in rows}.get(key)
        return f"{self.name}__v{load}" if load else None

    def publish(self, rows: DataFrame, drop: Collection[str] = (), replace: bool = True, lying: bool = False,
                refused: Callable[[DataFrame], int] | None = None) -> DataFrame:
        """Replace the partitions that ``rows`` (with their partition column) hold, or add to them, and drop those named; return the table.

        ``rows`` may read the table. Only the last statement changes what readers see. Rows ``lying`` together by partition already
        are written without an exchange. If ``refused`` counts any among what was written, it is removed and that is an error.
        """
        load = uuid.uuid4().hex
        placed = sinks.as_declared(rows, self.stored_schema)
        sorted_rows = placed.sortWithinPartitions(self.partition, *self.cluster) if lying else sinks.clustered(placed, self.partition, self.cluster)
        write_parquet(sorted_rows, f"{self.root}/load={load}", self.partition)
        bad = refused(self._written(load)) if refused else 0
        if bad:
            self._remove(f"{self.root}/load={load}")
            raise ValueError(f"the batch has {bad} rows outside the window or without a day")
        written = {name.split("=")[1] for name in _children(self.spark, f"{self.root}/load={load}", f"{self.partition}=")}
        if not (written or replace):
            self._remove(f"{self.root}/load={load}")
            return self.rows()
        self._enter(load)
        current = self._property(_VERSION) if self.exists() else None
        gone = set(drop) | (written if replace else set())
        live = {f for f in self.folders() if f[0] not in gone} | {(value, load) for value in written}
        version = f"{self.name}__v{load}"
        self._register(version, live)
        self._switch(version, current.rpartition("__v")[2] if current else "")
        self._clean(version, current)
        return self.rows()

    def _enter(self, load: str) -> None:
        """The ledger's entries of a load, counted on the columns they need of what was written."""
        counts = self._written(load).groupBy(self.partition, self.counted).agg(F.count(F.lit(1)).alias("rows"), F.max(self.mark).alias(self.mark))
        write_parquet(counts, f"{self.root}/{_LEDGER}/load={load}")

    def _register(self, version: str, live: set[tuple[str, str]]) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.stored_schema)
        self.spark.sql(
            f"CREATE TABLE {version} ({columns}, `load` string) USING parquet PARTITIONED BY (`load`, `{self.partition}`) LOCATION '{self.root}'"
        )
        named = [f"PARTITION (`load` = '{load}', `{self.partition}` = DATE'{value}')" for value, load in sorted(live)]
        for at in range(0, len(named), _STATEMENT_PARTITIONS):
            self.spark.sql(f"ALTER TABLE {version} ADD {' '.join(named[at : at + _STATEMENT_PARTITIONS])}")

    def _switch(self, version: str, previous: str) -> None:
        columns = ", ".join(f"`{c}`" for c in self.stored_schema.fieldNames())
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{_VERSION}' = '{version.rpartition("__v")[2]}', '{_PREVIOUS}' = '{previous}') "
            f"AS SELECT {columns} FROM {version}"
        )

    def _clean(self, version: str, current: str | None) -> None:
        """Remove versions and folders that neither ``version`` nor the one before it uses."""
        kept = [v for v in (version, current) if v]
        database, _, short = self.name.rpartition(".")
        shown = self.spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{short}__v*'").collect()
        names = {v.rpartition(".")[2].lower() for v in kept}
        for name in {r.tableName for r in shown}:
            if name.lower() not in names:
                self.spark.sql(f"DROP TABLE {database + '.' if database else ''}{name}")
        used = {folder for v in kept for folder in _folders(self.spark, v)}
        files, _ = sinks.file_system(self.spark, self.root)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for load in _children(self.spark, self.root, "load="):
            inside = _children(self.spark, f"{self.root}/{load}", f"{self.partition}=")
            unused = [value for value in inside if (value.split("=")[1], load.split("=")[1]) not in used]
            for value in [""] if len(unused) == len(inside) else [f"/{v}" for v in unused]:
                files.delete(path(f"{self.root}/{load}{value}"), True)
        loads = {f"load={load}" for _, load in used} | {f"load={v.rpartition('__v')[2]}" for v in kept}
        for load in set(_children(self.spark, f"{self.root}/{_LEDGER}", "load=")) - loads:
            files.delete(path(f"{self.root}/{_LEDGER}/{load}"), True)

    def _fresh(self, batch: DataFrame) -> DataFrame:
        return sinks.as_declared(batch, self.schema).withColumn(self.partition, self.unit_of(F.col(self.day_of)))

    def _written(self, load: str) -> DataFrame:
        return self.spark.read.schema(self.stored_schema).parquet(f"{self.root}/load={load}")

    def _without_day(self, written: DataFrame) -> int:
        """How many rows lack their day: they have a folder of their own."""
        return written.filter(F.col(self.partition).isNull()).count()

    def _staged(self, batch: DataFrame, required: Sequence[str]) -> tuple[DataFrame, list, str]:
        """The batch, stored once with its partition column, the partitions it touches and the folder.

        Rows without a required column are an error and nothing is published.
        """
        folder = f"{self.root}/_batch-{uuid.uuid4().hex}"
        write_parquet(self._fresh(batch), folder)
        fresh = self.spark.read.schema(self.stored_schema).parquet(folder)
        bad = reduce(or_, [F.col(c).isNull() for c in required])
        # Partition values come to the driver: days and months are bounded by the calendar.
        seen = fresh.agg(F.count_if(bad).alias("bad"), F.collect_set(self.partition).alias("touched")).first()
        if seen.bad:
            self._remove(folder)
            raise ValueError(f"the batch has {seen.bad} rows without one of {list(required)}")
        return fresh, seen.touched, folder

    def _remove(self, folder: str) -> None:
        files, path = sinks.file_system(self.spark, folder)
        files.delete(path, True)

    def upsert(self, batch: DataFrame, keys: Sequence[str], keep: Sequence[str], order: Sequence[str] = ("_extracted_at", "id")) -> DataFrame:
        """Insert or update by key, rewriting only the folders of the batch's days (see ``sinks.upsert``).

        Old and new rows are shuffled once, to where they are merged and written.
        """
        if self.day_of not in keys:
            raise ValueError(f"{self.day_of} must be one of the keys")
        fresh, touched, folder = self._staged(batch, keys)
        if not touched:
            self._remove(folder)
            return self.rows()
        place = [k for k in keys if k != self.day_of] or [self.day_of]
        by_place = fresh.groupBy(self.partition, *place).agg(F.count(F.lit(1)).alias("rows"))
        # A row a folder: days and months are bounded by the calendar.
        counted = {r[0]: r for r in by_place.groupBy(self.partition).agg(F.sum("rows").alias("rows"), F.max("rows").alias("most")).collect()}
        held = {r[0]: r["rows"] for r in self.ledger().groupBy(self.partition).agg(F.sum("rows").alias("rows")).collect()}
        if max(r["most"] for r in counted.values()) > HOT_ROWS:
            # Of a key repeated that often each task sends one row.
            fresh = dedup_latest(fresh, keys, order)
        parts = {folder: math.ceil((r["rows"] + held.get(folder, 0)) / ROWS_PER_FILE) for folder, r in counted.items()}
        many = [F.lit(x) for folder, n in sorted(parts.items()) if n > 1 for x in (folder, n)]
        part = F.pmod(F.xxhash64(*place), F.coalesce(F.try_element_at(F.create_map(*many), F.col(self.partition)), F.lit(1))) if many else F.lit(0)
        target = self.stored().filter(F.col(self.partition).isin(touched))
        merged = sinks.upsert(target, fresh, keys, keep, order, by=[F.col(self.partition), part])
        table = self.publish(merged, lying=True)
        self._remove(folder)
        return table

    def append(self, batch: DataFrame) -> DataFrame:
        """Add a batch in folders of its own. A row without its day is an error."""
        return self.publish(self._fresh(batch), replace=False, refused=self._without_day)

    def truncate(self, batch: DataFrame) -> DataFrame:
        """Replace the whole table by a batch."""
        return self.publish(self._fresh(batch), drop=self.partitions(), refused=self._without_day)

    def reload(self, batch: DataFrame, start, end=None, unbounded: bool = False) -> DataFrame:
        """Drop the rows of ``[start, end]`` (``unbounded``: and all later ones) and add the batch, which must lie inside.

        Only the folders of the window are replaced, and of the old rows only those of its first and last folder are read. The batch is
        written once, to where it stays.
        """
        day = F.col(self.day_of).cast("date")
        inside = day >= as_date(start)
        if not unbounded:
            inside = inside & (day <= as_date(end))
        ends = [self.unit_of(start), self.unit_of(start if unbounded else end)]
        first, last = self.spark.range(1).select(*[c.cast("string").alias(f"at{k}") for k, c in enumerate(ends)]).first()
        old = [v for v in self.partitions() if v >= first and (unbounded or v <= last)]
        outside = self.stored().filter(F.col(self.partition).isin(*[F.lit(v).cast("date") for v in {first, last}]) & ~inside)
        edges = F.col(self.partition).isNull() | (F.col(self.partition) <= F.lit(first).cast("date"))
        if not unbounded:
            edges = edges | (F.col(self.partition) >= F.lit(last).cast("date"))

        def refused(written: DataFrame) -> int:
            # Folders between hold days inside only. Of the others the table's own rows are outside too.
            return written.filter(edges & (day.isNull() | ~inside)).count() - outside.count()

        return self.publish(outside.unionByName(self._fresh(batch)), drop=old, refused=refused)


def _children(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    files, path = sinks.file_system(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path) if s.getPath().getName().startswith(prefix)] if files.exists(path) else []


def _folders(spark: SparkSession, version: str) -> set[tuple[str, str]]:
    """(partition value, load) of each folder of a version."""
    parts = [r.partition.split("/") for r in spark.sql(f"SHOW PARTITIONS {version}").collect()]
    return {(value.split("=")[1], load.split("=")[1]) for load, value in parts}
