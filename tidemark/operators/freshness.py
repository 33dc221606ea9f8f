"""Freshness: how long rows take from their own time until they are seen.

Two forms of the same report per tumbling window: exact percentiles, which need every
lag of a window, and quantile sketches, which are small, can be stored, and merge into
those of longer spans without going back to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN_SECONDS = 480              # alarm at 8 minutes
BREACH_SECONDS = 600            # the agreed 10 minutes
SKETCH_K = 800                  # rank error of about 0.4 %; a window's sketch takes some kilobytes


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def lags(df: DataFrame, event_ts: str, seen_ts: str, window: str = "1 hour") -> DataFrame:
    """``df`` with ``window_start`` (of the event's time) and ``lag_ms`` (never below 0).

    Rows without one of the times are left out; a clock that runs ahead counts as no lag.
    """
    lag = F.floor((_micros(seen_ts) - _micros(event_ts)) / 1000)
    return (df.where(F.col(event_ts).isNotNull() & F.col(seen_ts).isNotNull())
            .withColumn("window_start", F.window(F.col(event_ts).cast("timestamp"), window)["start"])
            .withColumn("lag_ms", F.greatest(lag, F.lit(0))))


def alarm(p95_ms: Column, warn: float = WARN_SECONDS, breach: float = BREACH_SECONDS) -> Column:
    """``breach`` above the agreed limit, ``warn`` from the alarm level on, else ``ok``."""
    return (F.when(p95_ms > breach * 1000, F.lit("breach")).when(p95_ms >= warn * 1000, F.lit("warn"))
            .otherwise(F.lit("ok")))


def exact_report(lagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, median and p95 in seconds (interpolated) and the alarm of every window.

    ``percentile`` keeps counts by distinct lag, so its state grows with a window's
    distinct milliseconds, not with its rows.
    """
    keys = ["window_start", *(by or [])]
    out = lagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.percentile("lag_ms", F.lit(0.5)).alias("_p50"),
        F.percentile("lag_ms", F.lit(0.95)).alias("_p95"))
    return out.select(*keys, "rows", F.round(F.col("_p50") / 1000, 3).alias("p50_s"),
                      F.round(F.col("_p95") / 1000, 3).alias("p95_s"), alarm(F.col("_p95")).alias("alarm"))


def sketches(lagged: DataFrame, by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """One quantile sketch (binary) for every window: a partial aggregate of bounded state."""
    return lagged.groupBy("window_start", *(by or [])).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_bigint("lag_ms", F.lit(k)).alias("sketch"))


def sketch_report(stored: DataFrame, window: str = "1 day", by: list[str] | None = None,
                  k: int = SKETCH_K) -> DataFrame:
    """The report of longer windows from stored sketches alone."""
    keys = ["window_start", *(by or [])]
    merged = (stored.withColumn("window_start", F.window("window_start", window)["start"])
              .groupBy(*keys).agg(F.sum("rows").alias("rows"),
                                  F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch")))
    at = lambda q: F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))
    return merged.select(*keys, "rows", (at(0.5) / 1000).alias("p50_s"), (at(0.95) / 1000).alias("p95_s"),
                         alarm(at(0.95)).alias("alarm"))
