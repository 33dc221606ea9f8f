"""Watermark state and the event log: small append-only JSON tables.

State rows: ``{"table", "checkpoint", "run_id", "written_at"}``.  The mark
of a table is the greatest parseable ``checkpoint`` over rows of that
table, of the shared table ``"*"``, or without a table (a single-object
file such as ``{"checkpoint": "2026-03-18T12:14:47.312228+00:00"}``).
Missing folder, missing key, bad text: the epoch.  Appending (instead of
rewriting a file) makes a write idempotent and never loses the old mark.

Logs grow by a file a run.  :func:`compact_log` folds them into one checkpoint of known
files, published by a rename; a read is then the newest checkpoint and the files that it
does not name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefmt import EPOCH, iso_text, parse_iso, py_iso
from tidemark.sources.lake import _path_exists

SHARED = "*"

STATE_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("checkpoint", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("written_at", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("schema_fingerprint", T.StringType()),
    T.StructField("delta_row_count", T.LongType()),
    T.StructField("lake_paths", T.ArrayType(T.StringType())),
    T.StructField("checkpoint_after", T.StringType()),
])


CHECKPOINTS = "_checkpoints"     # hidden from plain reads of the folder


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm, jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration())


def _data_files(spark: SparkSession, path: str) -> list[str]:
    jvm, fs = _fs(spark, path)
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName()[0] not in "._")


def _newest_checkpoint(spark: SparkSession, path: str) -> tuple[int, str | None]:
    jvm, fs = _fs(spark, path)
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{CHECKPOINTS}")
    done = sorted(s.getPath().getName() for s in (fs.listStatus(p) if fs.exists(p) else [])
                  if s.getPath().getName().isdigit())
    return (int(done[-1]), f"{path}/{CHECKPOINTS}/{done[-1]}") if done else (0, None)


def _read_log(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """The newest checkpoint and the files after it; without one, the folder as it is."""
    path = path.rstrip("/")
    reader = spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
    _, base = _newest_checkpoint(spark, path)
    if base is None:
        return reader.json(path)
    rows = spark.read.parquet(f"{base}/rows")
    known = {r[0] for r in spark.read.parquet(f"{base}/files").collect()}
    tail = [f"{path}/{f}" for f in _data_files(spark, path) if f not in known]
    return rows.unionByName(reader.json(tail)) if tail else rows


def compact_log(spark: SparkSession, path: str, schema: T.StructType, keep_rows: list[str] | None = None,
                fold: Callable[[DataFrame], DataFrame] | None = None, remove: bool = True,
                hook: Callable[[str], None] | None = None) -> int:
    """Fold a log's files into a new checkpoint; returns its number.

    ``keep_rows`` names the columns that identify a row (the same run written twice counts
    once); ``fold`` reduces the rows further, e.g. :func:`newest_marks`.  The checkpoint
    (rows, and the names of the files it holds) is written under a temporary name and
    published by renaming it; a failure at any step leaves the log readable as it was.
    ``remove`` then deletes the files that the checkpoint names, and older checkpoints: a
    failure there leaves files that no reader counts twice.  Appends may go on meanwhile: files
    that were not listed are the tail.  One compaction of a log runs at a time.
    ``hook`` is called with every step's name, for tests of failures.
    """
    path, told = path.rstrip("/"), hook or (lambda step: None)
    jvm, fs = _fs(spark, path)
    to_path = jvm.org.apache.hadoop.fs.Path
    number, base = _newest_checkpoint(spark, path)
    files = _data_files(spark, path)
    known = {r[0] for r in spark.read.parquet(f"{base}/files").collect()} if base else set()
    fresh = [f for f in files if f not in known]
    told("listed")
    if fresh:
        rows = spark.read.schema(schema).option("mode", "PERMISSIVE").json([f"{path}/{f}" for f in fresh])
        if base:
            rows = rows.unionByName(spark.read.parquet(f"{base}/rows"))
        if keep_rows:
            rows = rows.dropDuplicates(keep_rows)
        temp = f"{path}/{CHECKPOINTS}/.{uuid.uuid4().hex}"
        (fold(rows) if fold else rows).write.parquet(f"{temp}/rows")
        told("rows")
        left = sorted((known & set(files)) | set(fresh))
        spark.createDataFrame([(f,) for f in left], "file string").coalesce(1).write.parquet(f"{temp}/files")
        told("files")
        number += 1
        base = f"{path}/{CHECKPOINTS}/{number:012d}"
        if not fs.rename(to_path(temp), to_path(base)):
            raise RuntimeError(f"checkpoint {number} of {path} exists")
        told("published")
        known = set(left)
    if remove and base:
        for f in sorted(known & set(files)):
            fs.delete(to_path(f"{path}/{f}"), False)
            told("removed")
        for s in fs.listStatus(to_path(f"{path}/{CHECKPOINTS}")):
            if s.getPath().getName().isdigit() and int(s.getPath().getName()) < number:
                fs.delete(s.getPath(), True)
    return number


def newest_marks(rows: DataFrame) -> DataFrame:
    """State rows reduced to the one of the greatest readable checkpoint of every table."""
    told = F.struct(parse_iso("checkpoint").alias("ts"), F.col("checkpoint"), F.col("run_id"), F.col("written_at"))
    best = (rows.withColumn("table", F.coalesce("table", F.lit(SHARED)))
            .where(parse_iso("checkpoint").isNotNull()).groupBy("table").agg(F.max(told).alias("b")))
    return best.select("table", "b.checkpoint", "b.run_id", "b.written_at")


def compact_state(spark: SparkSession, path: str, **kw) -> int:
    """Fold the state log to one row a table: the marks read from it are the same."""
    return compact_log(spark, path, STATE_SCHEMA, fold=newest_marks, **kw)


def compact_events(spark: SparkSession, path: str, **kw) -> int:
    """Fold the event log, one row for each (table, run id)."""
    return compact_log(spark, path, EVENT_SCHEMA, keep_rows=["table", "run_id"], **kw)


def read_state(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return _read_log(spark, path, STATE_SCHEMA, multiline)


def watermark_table(state: DataFrame) -> DataFrame:
    """``(table, mark)``: greatest parseable checkpoint per table name
    (``"*"`` for shared rows and rows without a table)."""
    parsed = state.select(F.coalesce("table", F.lit(SHARED)).alias("table"),
                          parse_iso("checkpoint").alias("ts"))
    return parsed.groupBy("table").agg(iso_text(F.max("ts")).alias("mark"))


def read_watermarks(spark: SparkSession, path: str, tables: list[str],
                    multiline: bool = False) -> dict[str, datetime]:
    """The marks as driver values (one tiny job; epoch when nothing valid).

    A table's mark is the later of its own and the shared one.
    """
    if not _path_exists(spark, path):
        return {t: EPOCH for t in tables}
    best = {r["table"]: datetime.fromisoformat(r["mark"]) for r in
            watermark_table(read_state(spark, path, multiline)).collect()
            if r["mark"] is not None}
    shared = best.get(SHARED)
    out = {}
    for t in tables:
        cands = [m for m in (best.get(t), shared) if m is not None]
        out[t] = max(cands) if cands else EPOCH
    return out


def write_watermarks(spark: SparkSession, path: str, marks: dict[str, datetime | str],
                     run_id: str) -> None:
    now = py_iso(datetime.now(tz=timezone.utc))
    rows = [(t, m if isinstance(m, str) else py_iso(m), run_id, now) for t, m in marks.items()]
    if rows:
        spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("append").json(path)


def append_events(spark: SparkSession, path: str, events: list[dict],
                  echo: bool = True) -> None:
    """Append one JSON line per event and print it (the console sink)."""
    if not events:
        return
    if echo:
        for e in events:
            print(json.dumps(e, ensure_ascii=False), flush=True)
    rows = [tuple(e[f.name] for f in EVENT_SCHEMA.fields) for e in events]
    spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").json(path)


def read_events(spark: SparkSession, path: str, dedup: bool = False) -> DataFrame:
    """The event log; ``dedup`` keeps one event per (table, checkpoint_after).

    A retried run can log a table twice with a new run id (events are
    at-least-once); the pair (table, checkpoint_after) identifies it.
    """
    ev = _read_log(spark, path, EVENT_SCHEMA)
    if dedup:
        ev = ev.dropDuplicates(["table", "checkpoint_after"])
    return ev
