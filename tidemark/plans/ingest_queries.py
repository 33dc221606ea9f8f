"""Registered ingest / lake queries over the driver's ``events`` and ``orders``.

``events`` (key ``event_id``, time ``ts``) and ``orders`` (key
``o_orderkey``, time ``o_orderdate``) play the two ingested tables.  Each
query that writes uses a fresh folder under the shared checkpoint folder.
Two-run scenarios model the source as it stood at an earlier time by its
own timestamp (``ts <= CUT``), then as it stands now (the whole table).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefmt import iso_text, py_iso
from tidemark.operators.search import search_one
from tidemark.operators.versions import late_rows, latest_version
from tidemark.plans.ingest import delta_summary
from tidemark.plans.ingest import run_ingest as ingest
from tidemark.plans.pipeline import ingest_and_reindex
from tidemark.plans.queries import load
from tidemark.session import scratch_path
from tidemark.sources import lake as lake_io
from tidemark.sources import state as state_io
from tidemark.sources.tables import incremental_scan, mark_literal
from tidemark.specs import TableSpec

UTC = timezone.utc
# Scenario parameters (marks and cut points inside the data's time span).
EVENTS_MARK = datetime(2024, 1, 20, tzinfo=UTC)
ORDERS_MARK = datetime(1998, 1, 1, tzinfo=UTC)
SHARED_MARK = datetime(1998, 1, 1, tzinfo=UTC)
CUT = datetime(2024, 1, 15, 12, 0, 0, tzinfo=UTC)
REPLAY_FROM = datetime(2024, 1, 14, 12, 0, 0, tzinfo=UTC)


def run_ingest(*args, **kwargs):
    """A run without the console copy of its events (they are read from the log)."""
    return ingest(*args, echo=False, **kwargs)


def events_spec(spark, sf_dir, source: DataFrame | None = None) -> TableSpec:
    return TableSpec("events", "event_id", "ts",
                     source if source is not None else load(spark, sf_dir, "events"))


def orders_spec(spark, sf_dir) -> TableSpec:
    return TableSpec("orders", "o_orderkey", "o_orderdate", load(spark, sf_dir, "orders"))


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        root = scratch_path(spark, name)
        self.lake = f"{root}/lake"
        self.state = f"{root}/state"
        self.events = f"{root}/events"


def _lake_view(df: DataFrame) -> DataFrame:
    """Typed lake rows back to the stored text form (ISO timestamps)."""
    return df.select(*[iso_text(c).alias(c) if t.startswith("timestamp") else F.col(c)
                       for c, t in df.dtypes])


def _read_events_lake(spark, root: str, source: DataFrame) -> DataFrame:
    schema = lake_io.lake_rows(source, "ts").schema
    good, _ = lake_io.read_lake(spark, root, "events", with_date(source.schema),
                                ["event_id", "ts"])
    return _lake_view(good).select(*schema.names)


def with_date(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("date", T.StringType())])


# ------------------------------------------------------------------ queries

def q_incremental_delta(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return lake_io.lake_rows(incremental_scan(ev, "ts", EVENTS_MARK), "ts")


def q_partition_plan(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    rows = lake_io.lake_rows(incremental_scan(ev, "ts", EVENTS_MARK), "ts")
    return rows.groupBy("date").agg(F.count(F.lit(1)).cast("long").alias("rows"))


def q_high_water_mark(spark, sf_dir):
    """Per-table marks, plus the single shared mark (``*``) over both."""
    specs = [events_spec(spark, sf_dir), orders_spec(spark, sf_dir)]
    per = delta_summary(spark, specs, {"events": EVENTS_MARK, "orders": ORDERS_MARK})
    before = F.when(F.col("table") == "events", F.lit(py_iso(EVENTS_MARK))).otherwise(
        F.lit(py_iso(ORDERS_MARK)))
    per = per.select("table", "delta_row_count", before.alias("checkpoint_before"),
                     F.coalesce("max_ts", before).alias("checkpoint_after"))
    sh = delta_summary(spark, specs, {"events": SHARED_MARK, "orders": SHARED_MARK})
    shared = sh.agg(F.sum("delta_row_count").cast("long").alias("delta_row_count"),
                    F.max("max_ts").alias("m")).select(
        F.lit(state_io.SHARED).alias("table"), "delta_row_count",
        F.lit(py_iso(SHARED_MARK)).alias("checkpoint_before"),
        F.coalesce("m", F.lit(py_iso(SHARED_MARK))).alias("checkpoint_after"))
    return per.unionByName(shared)


def _manifest_view(spark, manifest, root: str) -> DataFrame:
    df = manifest.to_dataframe(spark)
    rel = F.transform("lake_paths", lambda p: F.regexp_replace(p, "^.*/lake/", ""))
    return df.select("table", "delta_row_count", F.array_join(rel, ",").alias("lake_paths"),
                     "schema_fingerprint", "checkpoint_before", "checkpoint_after",
                     "dry_run")


def q_dry_run_manifest(spark, sf_dir):
    s = Scratch(spark, "dry_run")
    m = run_ingest(spark, [events_spec(spark, sf_dir), orders_spec(spark, sf_dir)],
                   s.lake, s.state, s.events, dry_run=True)
    return _manifest_view(spark, m, s.lake)


def _real_run(spark, sf_dir, name):
    s = Scratch(spark, name)
    m = run_ingest(spark, [events_spec(spark, sf_dir), orders_spec(spark, sf_dir)],
                   s.lake, s.state, s.events)
    return s, m


def q_run_manifest(spark, sf_dir):
    s, m = _real_run(spark, sf_dir, "run")
    return _manifest_view(spark, m, s.lake)


def q_event_log(spark, sf_dir):
    s, _ = _real_run(spark, sf_dir, "event_log")
    # a second run finds nothing new: no event, no mark change
    run_ingest(spark, [events_spec(spark, sf_dir), orders_spec(spark, sf_dir)],
               s.lake, s.state, s.events)
    ev = state_io.read_events(spark, s.events, dedup=True)
    return ev.select("table", "delta_row_count", F.size("lake_paths").cast("long").alias(
        "n_paths"), "schema_fingerprint", "checkpoint_after")


def q_watermark_state(spark, sf_dir):
    s, _ = _real_run(spark, sf_dir, "watermark")
    return state_io.watermark_table(state_io.read_state(spark, s.state)).select(
        "table", F.col("mark").alias("checkpoint"))


def q_recover_watermark(spark, sf_dir):
    """Rebuild lost marks from the lake: max stored timestamp per table."""
    s, _ = _real_run(spark, sf_dir, "recover")
    ev = lake_io.read_raw(spark, s.lake, "events").select(
        F.lit("events").alias("table"), F.col("ts").alias("t"))
    od = lake_io.read_raw(spark, s.lake, "orders").select(
        F.lit("orders").alias("table"), F.col("o_orderdate").alias("t"))
    both = ev.unionByName(od)
    return both.groupBy("table").agg(
        iso_text(F.max(F.try_to_timestamp("t"))).alias("checkpoint"))


def q_lake_round_trip(spark, sf_dir):
    src = load(spark, sf_dir, "events")
    s = Scratch(spark, "round_trip")
    run_ingest(spark, [events_spec(spark, sf_dir)], s.lake, s.state, s.events)
    return _read_events_lake(spark, s.lake, src)


def _two_runs(spark, sf_dir, name: str, mode: str, replay: bool):
    src = load(spark, sf_dir, "events")
    early = src.where(F.col("ts") <= mark_literal(CUT, src.schema["ts"].dataType))
    s = Scratch(spark, name)
    run_ingest(spark, [events_spec(spark, sf_dir, early)], s.lake, s.state, s.events, mode=mode)
    since = {"events": REPLAY_FROM} if replay else None
    run_ingest(spark, [events_spec(spark, sf_dir, src)], s.lake, s.state, s.events,
               mode=mode, since=since)
    return s, src


def q_lake_replace_two_runs(spark, sf_dir):
    """Replace mode: the date of the cut keeps only the second run's rows."""
    s, src = _two_runs(spark, sf_dir, "replace2", "replace", replay=False)
    return _read_events_lake(spark, s.lake, src)


def q_lake_merge_two_runs(spark, sf_dir):
    """Merge mode with a replayed overlap: every row exactly once."""
    s, src = _two_runs(spark, sf_dir, "merge2", "merge", replay=True)
    return _read_events_lake(spark, s.lake, src)


def q_late_row_audit(spark, sf_dir):
    """Source rows at or below the mark that the lake lacks (after replace)."""
    s, src = _two_runs(spark, sf_dir, "audit", "replace", replay=False)
    mark = state_io.read_watermarks(spark, s.state, ["events"])["events"]
    good, _ = lake_io.read_lake(spark, s.lake, "events", with_date(src.schema),
                                ["event_id", "ts"])
    have = good.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    missing = late_rows(src, have, "event_id", "ts",
                        mark_literal(mark, src.schema["ts"].dataType))
    return lake_io.lake_rows(missing, "ts")


def q_latest_version(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    latest = latest_version(ev, "user_id", ["ts"])
    return latest.select("user_id", "event_id", iso_text("ts").alias("ts"), "event_type",
                         "value")


def q_props_decode(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    parsed = F.from_json("props", "k bigint", {"mode": "PERMISSIVE"})
    return ev.select("event_id", parsed["k"].alias("k"),
                     F.expr("try_parse_json(props)").isNotNull().alias("valid_json"))


INGEST_QUERIES = {
    "incremental_delta": q_incremental_delta,
    "partition_plan": q_partition_plan,
    "high_water_mark": q_high_water_mark,
    "dry_run_manifest": q_dry_run_manifest,
    "run_manifest": q_run_manifest,
    "event_log": q_event_log,
    "watermark_state": q_watermark_state,
    "recover_watermark": q_recover_watermark,
    "lake_round_trip": q_lake_round_trip,
    "lake_replace_two_runs": q_lake_replace_two_runs,
    "lake_merge_two_runs": q_lake_merge_two_runs,
    "late_row_audit": q_late_row_audit,
    "latest_version": q_latest_version,
    "props_decode": q_props_decode,
}


def q_stream_index_refresh(spark, sf_dir):
    """Documents landing as several files, indexed by a streaming refresh
    (one micro-batch per file); the result equals the batch-built weights."""
    from tidemark.streaming.refresh import refreshed_index, start_refresh
    docs = load(spark, sf_dir, "documents")
    root = scratch_path(spark, "stream")
    docs.repartitionByRange(4, "doc_id").write.parquet(f"{root}/landing")
    q = start_refresh(spark, f"{root}/landing", docs.schema, f"{root}/index",
                      f"{root}/stream_ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    idx = refreshed_index(spark, f"{root}/index")
    return idx.postings.select("doc_id", "dim", F.round("w", 8).alias("w"))


INGEST_QUERIES["stream_index_refresh"] = q_stream_index_refresh


def q_lake_compaction(spark, sf_dir):
    """Daily compaction: the JSON-lines lake rewritten as sorted Parquet."""
    src = load(spark, sf_dir, "events")
    s = Scratch(spark, "compaction")
    run_ingest(spark, [events_spec(spark, sf_dir)], s.lake, s.state, s.events)
    out = lake_io.compact(spark, s.lake, "events", with_date(src.schema), ["event_id", "ts"],
                          f"{s.lake}_parquet/events")
    view = _lake_view(out.withColumn("date", F.col("date").cast("string")))
    return view.select(*lake_io.lake_rows(src, "ts").columns)


INGEST_QUERIES["lake_compaction"] = q_lake_compaction


def _broken_lake(spark, sf_dir, name: str) -> Scratch:
    """Events as a stored lake: every tenth id as text, every thirteenth line cut short."""
    src = lake_io.lake_rows(load(spark, sf_dir, "events"), "ts")
    s = Scratch(spark, name)
    cols = [c for c in src.columns if c not in ("event_id", "date")]
    whole = F.to_json(F.struct("event_id", *cols))
    as_text = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), *cols))
    line = F.when(F.col("event_id") % 13 == 0, F.substring(whole, 1, 20)).when(
        F.col("event_id") % 10 == 0, as_text).otherwise(whole)
    src.select("date", line.alias("value")).write.partitionBy("date").text(f"{s.lake}/events")
    return s


def _line_counts(spark, s: Scratch, src: DataFrame) -> DataFrame:
    good, bad = lake_io.read_lake(spark, s.lake, "events", with_date(src.schema), ["event_id", "ts"])
    both = good.select("date", F.col("event_id"), F.lit(0).alias("bad")).unionByName(
        bad.select("date", F.lit(None).cast("long").alias("event_id"), F.lit(1).alias("bad")))
    return both.groupBy("date").agg(
        F.count("event_id").cast("long").alias("readable"),
        F.countDistinct("event_id").cast("long").alias("ids"),
        F.sum("bad").cast("long").alias("malformed"))


def q_malformed_records(spark, sf_dir):
    """Per date: readable rows, distinct ids and quarantined lines of a damaged lake."""
    return _line_counts(spark, _broken_lake(spark, sf_dir, "malformed"),
                        load(spark, sf_dir, "events"))


def q_lake_merge_malformed(spark, sf_dir):
    """The whole table merged into the damaged lake: no line is lost."""
    src = load(spark, sf_dir, "events")
    s = _broken_lake(spark, sf_dir, "merge_malformed")
    run_ingest(spark, [events_spec(spark, sf_dir)], s.lake, s.state, s.events)
    return _line_counts(spark, s, src)


INGEST_QUERIES["malformed_records"] = q_malformed_records
INGEST_QUERIES["lake_merge_malformed"] = q_lake_merge_malformed


LAKE_QUERY = "purchase 42 error"


def q_search_from_lake(spark, sf_dir):
    """The whole path: projected source, ingest, lake, written index, search.

    The index text is two columns (event type and properties) of the lake's rows."""
    spec = TableSpec("events", "event_id", "ts", load(spark, sf_dir, "events"),
                     columns=("event_id", "ts", "event_type", "props"))
    s = Scratch(spark, "search_from_lake")
    done = ingest_and_reindex(spark, [spec], s.lake, s.state, s.events, spec,
                              ["event_type", "props"], ["event_type"], f"{s.lake}_index",
                              echo=False)
    if done.error is not None:
        raise done.error
    return search_one(spark, done.index, LAKE_QUERY, 50)


def q_watermark_fallback(spark, sf_dir):
    """Marks from a state written by others: with offset, naive, and bad text.

    One table per event type and kind of text; a table without a readable mark
    reads as the epoch."""
    s = Scratch(spark, "watermark_fallback")
    kind = (F.col("event_id") % 3).cast("string")
    ahead = F.date_format(F.col("ts").cast("timestamp") + F.expr("INTERVAL 2 HOURS"),
                          "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (F.when(kind == "0", F.concat(ahead, F.lit("+02:00")))
            .when(kind == "1", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("event_id") % 2 == 0, F.concat(F.lit("soon after "), iso_text("ts"))))
    rows = load(spark, sf_dir, "events").select(
        F.concat_ws("_", "event_type", kind).alias("table"), text.alias("checkpoint"))
    rows.write.json(s.state)
    names = [r["table"] for r in rows.select("table").distinct().collect()]  # types x 3
    marks = state_io.read_watermarks(spark, s.state, names)
    return spark.createDataFrame([(t, py_iso(m)) for t, m in marks.items()],
                                 "table string, checkpoint string")


def q_stream_versions(spark, sf_dir):
    """Conversation turns as versions landing in any order: the last turn is indexed.

    Every file holds several turns of a conversation and later files bring older
    ones; the batches are compacted before the weights are read."""
    from tidemark.streaming.refresh import compact_refresh, refreshed_index, start_refresh
    conv = load(spark, sf_dir, "conversations")
    root = scratch_path(spark, "stream_versions")
    spread = F.xxhash64("conv_id", "turn")
    conv.repartition(3, spread).write.parquet(f"{root}/landing")
    start_refresh(spark, f"{root}/landing", conv.schema, f"{root}/index",
                  f"{root}/stream_ckpt", id_col="conv_id", max_files_per_trigger=1,
                  version_col="turn", payload_cols=["role"]).awaitTermination()
    compact_refresh(spark, f"{root}/index")
    idx = refreshed_index(spark, f"{root}/index")
    return idx.postings.join(idx.payload_rows, "doc_id").select(
        F.col("doc_id").alias("conv_id"), "dim", F.round("w", 8).alias("w"), "role")


INGEST_QUERIES["search_from_lake"] = q_search_from_lake
INGEST_QUERIES["watermark_fallback"] = q_watermark_fallback
INGEST_QUERIES["stream_versions"] = q_stream_versions
