"""Incremental index refresh with Structured Streaming (ingest-then-index).

New lake files are read as a stream; each micro-batch tokenises only its
own documents and writes their term vectors into the index's ``terms``
table, partitioned by batch id with dynamic overwrite, so a retried batch
replaces its own output (foreachBatch is at-least-once).  Document
frequencies, N and weights depend on the whole corpus, so they are
re-derived from ``terms`` (no re-tokenising) when the index is read.  An id
keeps the vector of its greatest ``version_col``, whatever batch or file
brought it; without a version column, that of its newest batch.

The stream's checkpoint location plays the role of the mark: files already
processed are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import concat_text, term_vectors
from tidemark.operators.index import (TextIndex, _assemble, corpus_size, current_build,
                                      new_build, publish)
from tidemark.operators.versions import latest_version


def _batch_writer(index_path: str, id_col: str, text_cols: list[str],
                  version_col: str | None = None, payload_cols: list[str] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        version = F.col(version_col) if version_col else F.lit(0).cast("long")
        keep = ["doc_id", "_ver", *(payload_cols or [])]
        src = batch.select(F.col(id_col).alias("doc_id"), version.alias("_ver"),
                           *(payload_cols or []), concat_text(*text_cols).alias("_text"))
        # a file is often one row group, which one task reads: its texts are spread over the cores
        tasks = max(batch.sparkSession.sparkContext.defaultParallelism, batch.rdd.getNumPartitions())
        tv = term_vectors(src.repartition(tasks), "_text", keep).withColumn("batch_id", F.lit(batch_id))
        (tv.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{index_path.rstrip('/')}/terms"))
    return write


def start_refresh(spark: SparkSession, source_path: str, schema: T.StructType,
                  index_path: str, checkpoint_location: str, id_col: str = "doc_id",
                  text_cols: list[str] | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  available_now: bool = True, version_col: str | None = None,
                  payload_cols: list[str] | None = None) -> StreamingQuery:
    """Start the refresh stream (``availableNow`` drains what exists, then stops)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_path)
    writer = (stream.writeStream.foreachBatch(_batch_writer(
        index_path, id_col, text_cols or ["text"], version_col, payload_cols))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def _terms(spark: SparkSession, index_path: str) -> tuple[DataFrame, str]:
    """The stream's term table and its folder: the newest complete compaction, if any,
    with the batches written after it."""
    root = index_path.rstrip("/")
    batches = spark.read.parquet(f"{root}/terms")
    try:
        base = current_build(spark, root)
    except FileNotFoundError:
        return batches, root
    done = spark.read.parquet(f"{base}/terms")
    top = done.agg(F.max("batch_id")).first()[0]
    return done.unionByName(batches.where(F.col("batch_id") > F.lit(top))), base


def refreshed_index(spark: SparkSession, index_path: str) -> TextIndex:
    """The index over everything the stream has written so far."""
    terms, _ = _terms(spark, index_path)
    latest = latest_version(terms, "doc_id", ["_ver", "batch_id"]).drop("_ver", "batch_id")
    payload = [c for c in latest.columns if c not in ("doc_id", "terms")]
    return _assemble(latest.select("doc_id", "terms"), corpus_size(latest),
                     latest.select("doc_id", *payload), payload, None)


def compact_refresh(spark: SparkSession, index_path: str) -> int:
    """Collapse the stream's batches to the newest vector per id.

    Written as a new build that is published last; the batches stay until
    they are removed by hand, so a crash loses nothing, and batches newer
    than the compaction are read on top of it.  Returns its batch id.
    """
    root = index_path.rstrip("/")
    terms, _ = _terms(spark, root)
    top = terms.agg(F.max("batch_id")).first()[0]
    if top is None:
        return -1
    build = new_build()
    (latest_version(terms, "doc_id", ["_ver", "batch_id"])
     .withColumn("batch_id", F.lit(top)).write.parquet(f"{root}/build={build}/terms"))
    publish(spark, root, build)
    return int(top)
