"""Ingest, then rebuild the search index from the lake (one pipeline step).

The index is rebuilt from the whole lake (latest version per id) after a
real run that wrote something.  A failed rebuild does not fail the
ingest: the previous index stays in place and the error is returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.index import TextIndex, build_index, write_index
from tidemark.plans.ingest import IngestManifest, run_ingest
from tidemark.sources import lake as lake_io
from tidemark.specs import TableSpec


@dataclass
class PipelineResult:
    manifest: IngestManifest
    index: TextIndex | None
    rebuilt: bool
    error: Exception | None = None
    quarantined: int = 0        # lake lines that were not indexed


def lake_table(spark: SparkSession, lake_root: str, spec: TableSpec,
               schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """One lake table: its validated rows and its quarantined lines."""
    return lake_io.read_lake(spark, lake_root, spec.name, schema, spec.required_columns())


def ingest_and_reindex(spark: SparkSession, specs: list[TableSpec], lake_root: str,
                       state_path: str, events_path: str, index_spec: TableSpec,
                       text_cols: list[str], payload_cols: list[str], index_path: str,
                       current: TextIndex | None = None, mode: str = "merge",
                       dry_run: bool = False, echo: bool = True) -> PipelineResult:
    manifest = run_ingest(spark, specs, lake_root, state_path, events_path, mode=mode,
                          dry_run=dry_run, echo=echo)
    wrote = (not dry_run) and any(t.delta_row_count for t in manifest.tables)
    if not wrote:
        return PipelineResult(manifest, current, False)
    try:
        schema = index_spec.read(spark).schema
        rows, bad = lake_table(spark, lake_root, index_spec, schema)
        idx = build_index(rows, index_spec.key, text_cols, payload_cols,
                          version_col=index_spec.ts)
        return PipelineResult(manifest, write_index(idx, index_path), True,
                              quarantined=bad.count())
    except Exception as exc:  # noqa: BLE001 - a failed rebuild keeps the old index
        return PipelineResult(manifest, current, False, exc)


def register_lake_views(spark: SparkSession, lake_root: str,
                        tables: dict[str, tuple[T.StructType, list[str]]]) -> list[str]:
    """Temp views over validated lake tables, for ad-hoc SQL (``spark.sql``)."""
    for name, (schema, required) in tables.items():
        good, _ = lake_io.read_lake(spark, lake_root, name, schema, required)
        good.createOrReplaceTempView(name)
    return sorted(tables)
