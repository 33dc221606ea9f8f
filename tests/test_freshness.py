from datetime import timedelta

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import BASE
from tidemark.operators import freshness


def lagged(spark, seconds, step_s=30):
    rows = [(BASE + timedelta(seconds=step_s * i), BASE + timedelta(seconds=step_s * i + s))
            for i, s in enumerate(seconds)]
    return freshness.lags(spark.createDataFrame(rows, "ts timestamp, seen timestamp"), "ts", "seen")


def test_exact_report_and_alarm(spark):
    rng = np.random.default_rng(4)
    seconds = [int(x) for x in rng.integers(0, 700, 1000)]
    got = freshness.exact_report(lagged(spark, seconds)).orderBy("window_start").collect()
    for k, r in enumerate(got):
        part = seconds[120 * k:120 * (k + 1)]
        assert r.rows == len(part)
        assert abs(r.p95_s - np.percentile(part, 95)) < .002 and abs(r.p50_s - np.median(part)) < .002
    levels = {v: freshness.exact_report(lagged(spark, [v] * 20)).first().alarm for v in (479, 480, 600, 601)}
    assert levels == {479: "ok", 480: "warn", 600: "warn", 601: "breach"}


def test_missing_times_and_clocks_that_run_ahead(spark):
    df = spark.createDataFrame([(BASE, BASE - timedelta(seconds=9)), (BASE, None), (None, BASE)],
                               "ts timestamp, seen timestamp")
    r = freshness.exact_report(freshness.lags(df, "ts", "seen")).collect()
    assert [(x.rows, x.p95_s, x.alarm) for x in r] == [(1, 0.0, "ok")]


def test_sketches_merge_within_their_rank_error(spark):
    base = spark.range(0, 200_000, 1, 8).select(
        F.timestamp_seconds(F.lit(int(BASE.timestamp())) + F.col("id") % 86400).alias("ts"),
        F.pmod(F.xxhash64("id"), F.lit(700_000)).alias("ms"))
    df = freshness.lags(base.withColumn("seen", F.timestamp_micros(F.unix_micros("ts") + F.col("ms") * 1000)),
                        "ts", "seen")
    stored = freshness.sketches(df)
    assert stored.count() == 24 and stored.agg(F.max(F.octet_length("sketch"))).first()[0] < 30_000
    day = freshness.sketch_report(stored).first()
    assert day.rows == 200_000
    lags = np.sort([r[0] for r in df.select("lag_ms").collect()])
    for value, q in ((day.p50_s, .5), (day.p95_s, .95)):
        rank = np.searchsorted(lags, value * 1000) / len(lags)
        assert abs(rank - q) < .01                       # measured: below 0.005
    assert day.alarm == "breach"
