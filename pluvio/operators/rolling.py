"""Rolling means over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pluvio.config import ROLLING_ROWS


def rolling_avg(
    df: DataFrame, columns: dict[str, str], rows: int = ROLLING_ROWS, key: str | Sequence[str] = "location_id", order: str = "date"
) -> DataFrame:
    """Add ``{new name: column}`` means over the current row and the ``rows - 1`` before it.

    Counts rows, not days; the first windows are partial; nulls are skipped. ``df`` must be
    unique by (key, order), as staging output is: a location then holds at most one row per
    calendar day, some 37,000 rows for a century, however many rows the raw table repeats.
    """
    frame = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumns({name: F.avg(column).over(frame) for name, column in columns.items()})
