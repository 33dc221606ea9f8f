"""Incremental scans of source tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mark_literal(mark: datetime, dtype: T.DataType) -> Column:
    """The mark as a literal of the column's own type.

    Comparing the raw column with a literal (instead of casting the column)
    keeps the predicate pushable: Parquet shows it in ``PushedFilters``,
    JDBC puts it into the remote WHERE.  NTZ columns hold UTC wall time.
    """
    if mark.tzinfo is None:
        mark = mark.replace(tzinfo=timezone.utc)
    utc = mark.astimezone(timezone.utc)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(utc.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return F.lit(utc.date().isoformat()).cast("date")
    return F.lit(utc.isoformat()).cast("timestamp")


def incremental_scan(df: DataFrame, ts_col: str, since: datetime,
                     until: datetime | None = None) -> DataFrame:
    """Rows with ``since < ts`` (strict) and, if given, ``ts <= until``.

    The upper bound makes the write read exactly the rows the summary
    counted, even if newer rows land in between; they wait for the next
    run instead of racing the mark.
    """
    dtype = df.schema[ts_col].dataType
    out = df.where(F.col(ts_col) > mark_literal(since, dtype))
    if until is not None:
        out = out.where(F.col(ts_col) <= mark_literal(until, dtype))
    return out
