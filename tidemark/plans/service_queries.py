"""Registered queries of the service around the lake: segments, event dedup, tenants,
freshness, snapshots, digest audit, compacted state.  SQL beside each."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime, timedelta, timezone

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.timefmt import iso_text, parse_iso
from tidemark.operators import freshness
from tidemark.operators.search import search
from tidemark.operators.versions import late_rows_by_digest
from tidemark.plans.ingest import run_ingest as ingest
from tidemark.plans.ingest_queries import (CUT, Scratch, _two_runs, events_spec, orders_spec, run_ingest,
                                           with_date)
from tidemark.plans.oracle import BENCH_Q, search_sql
from tidemark.plans.pipeline import register_lake_views
from tidemark.plans.queries import benchmark_queries, load
from tidemark.session import scratch_path
from tidemark.sources import lake as lake_io
from tidemark.sources import snapshots, tenants
from tidemark.sources import state as state_io
from tidemark.sources.lake import lake_rows
from tidemark.sources.tables import mark_literal
from tidemark.streaming.dedup import start_dedup
from tidemark.streaming.segments import compact_segments, segment_index, start_segments

ORDERS_CUT = datetime(1996, 6, 30, tzinfo=timezone.utc)
REPEAT_AFTER_DAYS = 16


def _cut(df, ts, at):
    return mark_literal(at, df.schema[ts].dataType)


def q_stream_segments_search(spark, sf_dir):
    """Documents landing in three batches: new ones, revised ones, and an old version late.

    Two batches are indexed and compacted into a base, the third stays a segment; the
    search reads both.
    """
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    revised = F.concat(F.coalesce("text", F.lit("")), F.lit(" revised "), F.coalesce("lang", F.lit("")))
    third = F.col("doc_id") % 3
    first = docs.where(third == 0).withColumn("version", F.lit(1))
    again = docs.where("doc_id % 6 = 0").withColumn("text", revised).withColumn("version", F.lit(2))
    stale = docs.where("doc_id % 6 = 0").withColumn("text", F.lit("stale words only")).withColumn(
        "version", F.lit(0))
    landed = [first, docs.where(third == 1).withColumn("version", F.lit(1)).unionByName(again),
              docs.where(third == 2).withColumn("version", F.lit(1)).unionByName(stale)]
    root = scratch_path(spark, "segments")
    for n, part in enumerate(landed):
        part.write.mode("append").parquet(f"{root}/landing")
        start_segments(spark, f"{root}/landing", first.schema, f"{root}/index", f"{root}/stream",
                       version_col="version").awaitTermination()
        if n == 1:
            compact_segments(spark, f"{root}/index")
    return search(segment_index(spark, f"{root}/index"), benchmark_queries(spark, sf_dir), k_col=None)


def q_event_dedup(spark, sf_dir):
    """Events that arrive again: within two minutes (dropped), after 16 days (kept), late (dropped).

    The second batch of files comes to a stream restarted from its checkpoint.
    """
    ev = load(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    cut = F.lit(CUT.isoformat()).cast("timestamp")
    old = ev.where(F.col("ts") < cut)
    settled = ev.where(F.col("ts") < cut - F.expr("INTERVAL 1 DAY"))
    inside = old.where("event_id % 5 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 MINUTES"))
    outside = settled.where("event_id % 7 = 0").withColumn(
        "ts", F.col("ts") + F.expr(f"INTERVAL {REPEAT_AFTER_DAYS} DAYS"))
    late = settled.where("event_id % 11 = 0").withColumn("event_id", -F.col("event_id") - 1)
    files = [old.unionByName(inside), ev.where(F.col("ts") >= cut).unionByName(outside).unionByName(late)]
    root = scratch_path(spark, "event-dedup")
    for n, part in enumerate(files, start=1):
        part.withColumn("arrival", F.lit(n)).write.mode("append").parquet(f"{root}/landing")
        start_dedup(spark, f"{root}/landing", part.withColumn("arrival", F.lit(n)).schema, f"{root}/out",
                    f"{root}/stream", ["event_id"], "ts").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "arrival", "event_type")


def _order_runs(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    early = orders.where(F.col("o_orderdate") <= _cut(orders, "o_orderdate", ORDERS_CUT))
    return orders, early, scratch_path(spark, "tenant-marks")


def q_tenant_marks(spark, sf_dir):
    """Marks of every customer after two runs over orders, one job for all of them."""
    orders, early, marks = _order_runs(spark, sf_dir)
    for source in (early, orders):
        tenants.run_tenant_ingest(spark, source, "o_custkey", "o_orderkey", "o_orderdate", None, marks)
    return tenants.read_marks(spark, marks).select(
        F.col("tenant").cast("bigint").alias("o_custkey"), iso_text("mark").alias("mark"))


def q_tenant_delta(spark, sf_dir):
    """What the second run reads: orders newer than their own customer's mark."""
    orders, early, marks = _order_runs(spark, sf_dir)
    tenants.run_tenant_ingest(spark, early, "o_custkey", "o_orderkey", "o_orderdate", None, marks)
    delta = tenants.tenant_delta(orders, tenants.read_marks(spark, marks), "o_custkey", "o_orderdate")
    return delta.select("o_custkey", "o_orderkey", iso_text("o_orderdate").alias("o_orderdate"))


def q_tenant_layout(spark, sf_dir):
    """Events by type and date after two merged runs, read for the types ahead of the cut."""
    ev = load(spark, sf_dir, "events")
    root = scratch_path(spark, "tenant-lake")
    for source in (ev.where(F.col("ts") <= _cut(ev, "ts", CUT)), ev):
        tenants.run_tenant_ingest(spark, source, "event_type", "event_id", "ts", f"{root}/lake",
                                  f"{root}/marks")
    ahead = tenants.read_marks(spark, f"{root}/marks").where(F.col("tenant") >= "m").select("tenant")
    rows = tenants.read_tenant_lake(spark, f"{root}/lake").join(F.broadcast(ahead), "tenant")
    return rows.groupBy("tenant", "date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


#: Seconds from an event to its arrival: mostly short, long ones in some hours.
LAG_SECONDS = "(event_id * 7919 % 500) + CASE WHEN event_id % 17 = 0 THEN 400 ELSE 0 END"


def lagged_events(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    seen = F.timestamp_micros(F.unix_micros("ts") + F.expr(LAG_SECONDS) * 1_000_000)
    return freshness.lags(ev.withColumn("seen", seen), "ts", "seen")


def q_freshness_p95(spark, sf_dir):
    """Median, p95 and alarm of every hour, exactly."""
    out = freshness.exact_report(lagged_events(spark, sf_dir))
    return out.withColumn("window_start", iso_text("window_start"))


def q_lake_snapshot_read(spark, sf_dir):
    """Two runs: the second version, and the first one read again after it."""
    ev = load(spark, sf_dir, "events")
    root = scratch_path(spark, "snapshots")
    replayed = ev.where(F.col("ts") > _cut(ev, "ts", CUT - timedelta(days=1)))
    for part in (ev.where(F.col("ts") <= _cut(ev, "ts", CUT)), replayed):
        dates = [r[0] for r in lake_rows(part, "ts").select("date").distinct().collect()]
        snapshots.write_snapshot(spark, part, root, "events", "event_id", "ts", dates)
    schema = with_date(lake_rows(ev, "ts").drop("date").schema)
    reads = [snapshots.read_snapshot(spark, root, "events", schema, n).withColumn("version", F.lit(n))
             for n in (1, 2)]
    return reads[0].unionByName(reads[1]).groupBy("version", "date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"), F.max("ts").alias("last"))


def q_late_row_digest(spark, sf_dir):
    """The late-row audit by digests: only the date of the cut is joined."""
    s, src = _two_runs(spark, sf_dir, "digest", "replace", replay=False)
    mark = state_io.read_watermarks(spark, s.state, ["events"])["events"]
    good, _ = lake_io.read_lake(spark, s.lake, "events", with_date(src.schema), ["event_id", "ts"])
    have = good.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "date")
    audit = late_rows_by_digest(src, have, "event_id", "ts", mark_literal(mark, src.schema["ts"].dataType))
    return lake_rows(audit.rows, "ts").withColumn("dates_joined", F.lit(len(audit.differ)).cast("long"))


def q_compacted_state(spark, sf_dir):
    """Marks of every event type after daily runs, folded twice, with runs between and after."""
    ev = load(spark, sf_dir, "events").select("event_type", "ts", F.dayofmonth("ts").alias("day"))
    path = scratch_path(spark, "folded-state")
    for low, high in ((1, 10), (11, 20), (21, 31)):
        runs = ev.where(F.col("day").between(low, high)).groupBy("event_type", "day").agg(
            iso_text(F.max("ts")).alias("checkpoint"))
        (runs.select(F.col("event_type").alias("table"), "checkpoint",
                     F.concat(F.lit("run-"), "day").alias("run_id"), F.lit(None).cast("string").alias("written_at"))
         .repartition(high - low + 1, "day").write.mode("append").json(path))
        if high < 31:
            state_io.compact_state(spark, path)
    return state_io.watermark_table(state_io.read_state(spark, path)).select(
        "table", F.col("mark").alias("checkpoint"))


def q_lake_sql_view(spark, sf_dir):
    """Ad-hoc SQL over a validated lake table registered as a view."""
    src = load(spark, sf_dir, "events")
    s = Scratch(spark, "sql-view")
    run_ingest(spark, [events_spec(spark, sf_dir)], s.lake, s.state, s.events)
    register_lake_views(spark, s.lake, {"events": (with_date(src.schema), ["event_id", "ts"])})
    return spark.sql("""SELECT event_type, date, count(*) AS rows, round(sum(value), 4) AS total
                        FROM events GROUP BY event_type, date""")


def q_lake_line_order(spark, sf_dir):
    """Lines of every lake file ascend by time: (date, lines, lines out of order)."""
    s = Scratch(spark, "line-order")
    run_ingest(spark, [events_spec(spark, sf_dir)], s.lake, s.state, s.events)
    lines = (spark.read.option("basePath", f"{s.lake}/events").text(f"{s.lake}/events")
             .withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
             .select(F.col("date").cast("string").alias("date"), "file", "at",
                     F.get_json_object("value", "$.ts").alias("ts")))
    before = F.lag("ts").over(Window.partitionBy("date", "file").orderBy("at"))
    late = F.coalesce(parse_iso("ts") < parse_iso(before), F.lit(False))
    return lines.withColumn("late", late).groupBy("date").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("late").alias("out_of_order"))


def q_lake_set_difference(spark, sf_dir):
    """Rows that only the source or only a replaced lake holds (with counts of repeats)."""
    s, src = _two_runs(spark, sf_dir, "difference", "replace", replay=False)
    good, _ = lake_io.read_lake(spark, s.lake, "events", with_date(src.schema), ["event_id", "ts"])
    view = good.select(*[F.col(c).cast(t) for c, t in src.dtypes])
    sides = (("source", src.exceptAll(view)), ("lake", view.exceptAll(src)))
    out = [df.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.count(F.lit(1)).alias("rows"))
           .select(F.lit(name).alias("only_in"), "date", "rows") for name, df in sides]
    return out[0].unionByName(out[1])


def q_event_echo(spark, sf_dir):
    """What a run prints: its events, one JSON line each, as the log holds them."""
    s, printed = Scratch(spark, "echo"), io.StringIO()
    with contextlib.redirect_stdout(printed):
        ingest(spark, [events_spec(spark, sf_dir), orders_spec(spark, sf_dir)], s.lake, s.state, s.events)
    lines = spark.createDataFrame([(x,) for x in printed.getvalue().splitlines()], "line string")
    told = lines.select(F.from_json("line", state_io.EVENT_SCHEMA).alias("e")).select("e.*")
    same = told.exceptAll(state_io.read_events(spark, s.events)).count() == 0
    return told.select("table", "delta_row_count", F.size("lake_paths").cast("long").alias("n_paths"),
                       "checkpoint_after", F.lit(same).alias("as_logged"))


SERVICE_QUERIES = {
    "late_row_digest": q_late_row_digest,
    "compacted_state": q_compacted_state,
    "lake_sql_view": q_lake_sql_view,
    "lake_line_order": q_lake_line_order,
    "lake_set_difference": q_lake_set_difference,
    "event_echo": q_event_echo,
    "stream_segments_search": q_stream_segments_search,
    "event_dedup": q_event_dedup,
    "tenant_marks": q_tenant_marks,
    "tenant_delta": q_tenant_delta,
    "tenant_layout": q_tenant_layout,
    "freshness_p95": q_freshness_p95,
    "lake_snapshot_read": q_lake_snapshot_read,
}


def _iso(x: str) -> str:
    return (f"strftime({x}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({x}) % 1000000 <> 0 "
            f"THEN strftime({x}, '.%f') ELSE '' END || '+00:00'")


_CUT = f"TIMESTAMP '{CUT:%Y-%m-%d %H:%M:%S}'"
_OCUT = f"TIMESTAMP '{ORDERS_CUT:%Y-%m-%d %H:%M:%S}'"

SERVICE_ORACLE = {
    "late_row_digest": f"""
SELECT event_id, {_iso('ts')} AS ts, user_id, event_type, value, props,
  strftime(ts, '%Y-%m-%d') AS date, 1::BIGINT AS dates_joined
FROM events WHERE CAST(ts AS DATE) = CAST({_CUT} AS DATE) AND ts <= {_CUT}""",
    "compacted_state": f"""
SELECT event_type AS "table", {_iso('max(ts)')} AS checkpoint FROM events GROUP BY 1""",
    "lake_sql_view": """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, count(*) AS rows, round(sum(value), 4) AS total
FROM events GROUP BY 1, 2""",
    "lake_line_order": """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS lines, 0::BIGINT AS out_of_order
FROM events GROUP BY 1""",
    "lake_set_difference": f"""
SELECT 'source' AS only_in, strftime(ts, '%Y-%m-%d') AS date, count(*) AS rows FROM events
WHERE CAST(ts AS DATE) = CAST({_CUT} AS DATE) AND ts <= {_CUT} GROUP BY 2""",
    "event_echo": f"""
SELECT 'events' AS "table", count(*) AS delta_row_count,
  count(DISTINCT CAST(ts AS DATE)) AS n_paths, {_iso('max(ts)')} AS checkpoint_after, true AS as_logged
FROM events UNION ALL
SELECT 'orders', count(*), count(DISTINCT CAST(o_orderdate AS DATE)), {_iso('max(o_orderdate)')}, true
FROM orders""",
    "stream_segments_search": search_sql(
        BENCH_Q + """, newest AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0
  THEN coalesce(text, '') || ' revised ' || coalesce(lang, '') ELSE text END AS text FROM documents)""",
        5, "SELECT query_id, doc_id, rank, score FROM rk WHERE rank <= {k}", table="newest"),
    "event_dedup": f"""
SELECT event_id, CASE WHEN ts < {_CUT} THEN 1 ELSE 2 END AS arrival, event_type FROM events
UNION ALL
SELECT event_id, 2, event_type FROM events
WHERE ts < {_CUT} - INTERVAL 1 DAY AND event_id % 7 = 0""",
    "tenant_marks": f"""
SELECT o_custkey, {_iso('max(o_orderdate)')} AS mark FROM orders GROUP BY o_custkey""",
    "tenant_delta": f"""
SELECT o_custkey, o_orderkey, {_iso('o_orderdate')} AS o_orderdate FROM orders o
WHERE o_orderdate > coalesce((SELECT max(o_orderdate) FROM orders p
  WHERE p.o_custkey = o.o_custkey AND p.o_orderdate <= {_OCUT}), TIMESTAMP '1970-01-01')""",
    "tenant_layout": """
SELECT event_type AS tenant, strftime(ts, '%Y-%m-%d') AS date, count(*) AS rows,
  CAST(sum(event_id) AS BIGINT) AS ids FROM events WHERE event_type >= 'm' GROUP BY 1, 2""",
    "freshness_p95": f"""
WITH l AS (SELECT date_trunc('hour', ts) AS h, 1000 * ({LAG_SECONDS}) AS lag FROM events),
p AS (SELECT h, count(*) AS n, quantile_cont(lag, 0.5) AS p50, quantile_cont(lag, 0.95) AS p95
  FROM l GROUP BY h)
SELECT {_iso('h')} AS window_start, n AS rows, round(p50 / 1000, 3) AS p50_s,
  round(p95 / 1000, 3) AS p95_s, CASE WHEN p95 > 600000 THEN 'breach' WHEN p95 >= 480000 THEN 'warn'
  ELSE 'ok' END AS alarm FROM p""",
    "lake_snapshot_read": f"""
WITH r AS (SELECT 1 AS version, * FROM events WHERE ts <= {_CUT} UNION ALL SELECT 2, * FROM events)
SELECT version, strftime(ts, '%Y-%m-%d') AS date, count(*) AS rows,
  CAST(sum(event_id) AS BIGINT) AS ids, {_iso('max(ts)')} AS last FROM r GROUP BY 1, 2""",
}
