"""Timestamp text: ISO-8601 formatting and parsing (session time zone UTC)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
EPOCH_TEXT = "1970-01-01T00:00:00+00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_utc(ts) -> Column:
    """A ``timestamp`` (instant) column; NTZ values are read as UTC."""
    return _col(ts).cast("timestamp")


def iso_text(ts) -> Column:
    """ISO-8601 text with offset, microseconds only when non-zero.

    ``2026-03-18T12:14:47.312228+00:00``, ``2024-01-02T00:00:00+00:00``.
    Exact text (not Spark's JSON timestamp writer, which drops to
    milliseconds), so a strict ``>`` mark round-trips.
    """
    t = as_utc(ts)
    frac = F.when(F.unix_micros(t) % 1000000 != 0,
                  F.concat(F.lit("."), F.date_format(t, "SSSSSS"))).otherwise(F.lit(""))
    return F.when(t.isNotNull(), F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("+00:00")))


def parse_iso(text) -> Column:
    """Parse ISO-8601 text to ``timestamp``; naive text is UTC; bad -> null."""
    return F.try_to_timestamp(F.trim(_col(text)))


def py_iso(dt: datetime) -> str:
    """Python-side ISO text of a driver value (naive means UTC)."""
    if dt.tzinfo is None:
        dt = dt.replace(tzinfo=timezone.utc)
    return dt.astimezone(timezone.utc).isoformat()
