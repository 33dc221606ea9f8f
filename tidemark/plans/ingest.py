"""Incremental ingest run (and dry run) in the order lake -> events -> mark.

One run:

1. read the marks (per table by default; ``shared=True`` uses one mark for
   every table, the max over all deltas, as the in-memory service does);
2. one summary job over all tables: delta row count, max timestamp (as
   exact ISO text) and the sorted set of touched dates;
3. unless a dry run: write each non-empty delta to the lake, bounded by
   ``mark < ts <= new mark`` so the written rows are the counted rows;
   then append one event per non-empty table; then append the new marks.

A failure anywhere before step 3's last write leaves the marks unchanged,
so the run can simply be repeated: lake writes are idempotent per
partition, events are at-least-once (dedup by (table, checkpoint_after)).
Only small summary rows reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schema import fingerprint
from tidemark.functions.timefmt import as_utc, iso_text, py_iso
from tidemark.sources import lake as lake_io
from tidemark.sources import state as state_io
from tidemark.sources.tables import incremental_scan, mark_literal
from tidemark.specs import TableSpec

Writer = Callable[..., list[str]]


class InvalidSourceRows(ValueError):
    """Delta rows with NULL required fields: the run stops before writing."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(f"delta rows with NULL required fields: {counts}")
        self.counts = counts


@dataclass
class TableManifest:
    table: str
    delta_row_count: int
    lake_paths: list[str]
    schema_fingerprint: str
    checkpoint_before: str
    checkpoint_after: str
    dates: list[str] = field(default_factory=list)


@dataclass
class IngestManifest:
    run_id: str
    started_at: datetime
    finished_at: datetime
    tables: list[TableManifest]
    dry_run: bool
    shared: bool

    def table(self, name: str) -> TableManifest:
        return next(t for t in self.tables if t.table == name)

    @property
    def checkpoint_before(self) -> str:
        return max(t.checkpoint_before for t in self.tables)

    @property
    def checkpoint_after(self) -> str:
        return max(t.checkpoint_after for t in self.tables)

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        rows = [(self.run_id, t.table, t.delta_row_count, t.lake_paths, t.schema_fingerprint,
                 t.checkpoint_before, t.checkpoint_after, self.dry_run,
                 py_iso(self.started_at), py_iso(self.finished_at)) for t in self.tables]
        return spark.createDataFrame(
            rows, "run_id string, table string, delta_row_count long, "
                  "lake_paths array<string>, schema_fingerprint string, "
                  "checkpoint_before string, checkpoint_after string, dry_run boolean, "
                  "started_at string, finished_at string")


def delta_summary(spark: SparkSession, specs: list[TableSpec],
                  marks: dict[str, datetime]) -> DataFrame:
    """One row per table: ``table, delta_row_count, invalid_rows, max_ts (ISO),
    dates``.

    All tables in one job (a union of per-table partial aggregates); the
    date set is bounded by the calendar span of the delta.
    """
    parts = []
    for s in specs:
        # rows without a time are in no delta, so they are counted as invalid here
        d = s.read(spark).where(
            (F.col(s.ts) > mark_literal(marks[s.name], s.read(spark).schema[s.ts].dataType))
            | F.col(s.ts).isNull())
        bad = F.col(s.ts).isNull()
        for c in s.required_columns():
            bad = bad | F.col(c).isNull()
        parts.append(d.agg(
            F.count(s.ts).cast("long").alias("delta_row_count"),
            F.count_if(bad).cast("long").alias("invalid_rows"),
            iso_text(F.max(as_utc(s.ts))).alias("max_ts"),
            F.array_sort(F.collect_set(F.date_format(as_utc(s.ts), "yyyy-MM-dd"))).alias("dates"),
        ).select(F.lit(s.name).alias("table"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def plan_marks(summary_rows: list, specs: list[TableSpec], marks: dict[str, datetime],
               shared: bool) -> dict[str, datetime]:
    """New high-water marks: the max delta timestamp, else the old mark."""
    by = {r["table"]: r for r in summary_rows}
    new = {}
    for s in specs:
        m = by[s.name]["max_ts"]
        new[s.name] = datetime.fromisoformat(m) if m else marks[s.name]
    if shared:
        top = max(new.values())
        new = {k: top for k in new}
    return new


def run_ingest(spark: SparkSession, specs: list[TableSpec], lake_root: str, state_path: str,
               events_path: str, mode: str = "merge", dry_run: bool = False,
               shared: bool = False, since: dict[str, datetime] | None = None,
               writer: Writer | None = None, echo: bool = True) -> IngestManifest:
    """Run one incremental ingest; return its manifest.

    ``since`` overrides the stored marks (replay / backfill from a point).
    ``writer`` replaces the lake writer (same signature as
    :func:`tidemark.sources.lake.write_table`), e.g. to inject a failure.
    ``echo`` also prints each event as one JSON line.
    """
    run_id = str(uuid.uuid4())
    started = datetime.now(tz=timezone.utc)
    names = [s.name for s in specs]
    if since is not None:
        marks = {n: since[n] for n in names}
    else:
        key_names = [state_io.SHARED] if shared else names
        stored = state_io.read_watermarks(spark, state_path, key_names)
        marks = ({n: stored[state_io.SHARED] for n in names} if shared else stored)
    summary = delta_summary(spark, specs, marks).collect()
    invalid = {r["table"]: r["invalid_rows"] for r in summary if r["invalid_rows"]}
    if invalid:
        raise InvalidSourceRows(invalid)
    new_marks = plan_marks(summary, specs, marks, shared)
    by = {r["table"]: r for r in summary}
    write = writer or lake_io.write_table

    tables = []
    for s in specs:
        row = by[s.name]
        n = int(row["delta_row_count"])
        dates = list(row["dates"] or [])
        tables.append(TableManifest(
            table=s.name, delta_row_count=n, lake_paths=[],
            schema_fingerprint=fingerprint(s.read(spark).schema),
            checkpoint_before=py_iso(marks[s.name]),
            checkpoint_after=py_iso(marks[s.name] if dry_run else new_marks[s.name]),
            dates=dates))

    if not dry_run:
        for s, t in zip(specs, tables):
            if t.delta_row_count == 0:
                continue
            delta = incremental_scan(s.read(spark), s.ts, marks[s.name], new_marks[s.name])
            t.lake_paths = write(spark, delta, lake_root, s.name, s.key, s.ts, t.dates, mode)
        events = [{"table": t.table, "run_id": run_id,
                   "schema_fingerprint": t.schema_fingerprint,
                   "delta_row_count": t.delta_row_count, "lake_paths": t.lake_paths,
                   "checkpoint_after": t.checkpoint_after}
                  for t in tables if t.delta_row_count > 0]
        state_io.append_events(spark, events_path, events, echo=echo)
        moved = {t.table: t.checkpoint_after for t in tables
                 if t.checkpoint_after != t.checkpoint_before}
        if shared and moved:
            moved = {state_io.SHARED: max(moved.values())}
        state_io.write_watermarks(spark, state_path, moved, run_id)

    return IngestManifest(run_id=run_id, started_at=started,
                          finished_at=datetime.now(tz=timezone.utc), tables=tables,
                          dry_run=dry_run, shared=shared)
