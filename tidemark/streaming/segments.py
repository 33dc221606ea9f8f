"""A stream-fed index of immutable segments: a base and one segment per micro-batch.

A micro-batch tokenises its own documents and writes, each partitioned by batch id:

* ``terms``: its newest row of every id, with version, payload and term vector;
* ``dead``: (doc_id, dead_batch), the rows that this batch supersedes in earlier
  segments, or its own row where a stored one is newer;
* ``counts``: what it adds to df and N, per dimension, superseded rows taken off
  (``N_DIM`` counts documents).  Written last: a batch without counts is not read.

Counts of segments add up, so a search sums at most ``DIM`` + 1 small numbers for every
segment, leaves out the dead rows and weighs the stored vectors with the df of now: no
text is tokenised and nothing is aggregated over the corpus.  :func:`compact_segments`
merges all of it into a new base, published last.  A retried batch reads only segments
before it and overwrites its own partitions, so it writes the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import concat_text, term_vectors
from tidemark.operators.index import (TextIndex, _assemble, current_build, explode_terms, new_build,
                                      publish)
from tidemark.operators.versions import latest_version
from tidemark.sources.lake import _path_exists

N_DIM = -1


def _write(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def _partitions(spark: SparkSession, path: str) -> list[int]:
    """Batch ids that have a partition folder with data."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/[^_.]*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted({int(f.getPath().getParent().getName().split("=")[1]) for f in found or []})


class Segments:
    """The segments of one index that are complete, from the published base on."""

    def __init__(self, spark: SparkSession, path: str, before: int | None = None):
        self.spark, self.root = spark, path.rstrip("/")
        try:
            self.base: str | None = current_build(spark, self.root)
            self.top = int(self.base.rsplit("-", 1)[1], 16)
        except FileNotFoundError:
            self.base, self.top = None, -1
        self.tail = [b for b in _partitions(spark, f"{self.root}/counts")
                     if b > self.top and (before is None or b < before)]

    def _read(self, name: str) -> DataFrame | None:
        parts = [f"{self.base}/{name}"] if self.base and name != "dead" else []
        parts += [f"{self.root}/{name}/batch_id={b}" for b in self.tail
                  if _path_exists(self.spark, f"{self.root}/{name}/batch_id={b}")]
        frames = []
        for p in parts:
            root = self.base if self.base and p.startswith(self.base) else self.root
            frames.append(self.spark.read.option("basePath", f"{root}/{name}").parquet(p)
                          .withColumn("batch_id", F.col("batch_id").cast("long")))
        if not frames:
            return None
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def live(self, *cols: str) -> DataFrame | None:
        """Rows that no later segment supersedes."""
        rows, dead = self._read("terms"), self._read("dead")
        if rows is None:
            return None
        if cols:
            rows = rows.select(*cols)
        if dead is None:
            return rows
        gone = dead.select(F.col("doc_id").alias("_id"), "dead_batch")
        return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id"))
                         & (F.col("batch_id") == F.col("dead_batch")), "left_anti")

    def counts(self) -> DataFrame | None:
        """(dim, df): sums over the segments, at most DIM + 1 rows."""
        deltas = self._read("counts")
        return None if deltas is None else deltas.groupBy("dim").agg(F.sum("df").alias("df"))


def _dim_counts(terms: DataFrame, sign: int) -> DataFrame:
    dims = explode_terms(terms.select("terms"), []).select(F.col("t.dim").alias("dim"))
    dims = dims.unionByName(terms.select(F.lit(N_DIM).alias("dim")))
    return dims.groupBy("dim").agg((F.count(F.lit(1)) * sign).alias("df"))


def _segment_writer(root: str, id_col: str, text_cols: list[str], version_col: str | None,
                    payload: list[str]):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = F.col(version_col) if version_col else F.lit(0).cast("long")
        src = batch.select(F.col(id_col).alias("doc_id"), version.alias("_ver"), *payload,
                           concat_text(*text_cols).alias("_text"))
        newest = latest_version(src, "doc_id", ["_ver", "_text"])
        _write(term_vectors(newest, "_text", ["doc_id", "_ver", *payload])
               .withColumn("batch_id", F.lit(batch_id)), f"{root}/terms")
        if batch_id not in _partitions(spark, f"{root}/terms"):
            return                                            # an empty batch
        own = spark.read.parquet(f"{root}/terms/batch_id={batch_id}")
        earlier = Segments(spark, root, before=batch_id).live("doc_id", "_ver", "batch_id", "terms")
        added, taken = own, None
        if earlier is not None:
            met = (own.select(F.col("doc_id").alias("_id"), F.col("_ver").alias("_own"))
                   .join(earlier, F.col("_id").eqNullSafe(F.col("doc_id")))
                   .select("doc_id", "terms", F.coalesce(F.col("_own") >= F.col("_ver"),
                                                         F.col("_ver").isNull()).alias("_newer"),
                           F.col("batch_id").alias("_old")))
            met = met.checkpoint()                            # bounded by the batch
            _write(met.select("doc_id", F.when(F.col("_newer"), F.col("_old"))
                              .otherwise(F.lit(batch_id).cast("long")).alias("dead_batch"))
                   .withColumn("batch_id", F.lit(batch_id)), f"{root}/dead")
            stale = met.where("not _newer").select(F.col("doc_id").alias("_id"))
            added = own.join(stale, F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
            taken = met.where("_newer")
        counts = _dim_counts(added, 1)
        if taken is not None:
            counts = counts.unionByName(_dim_counts(taken, -1)).groupBy("dim").agg(
                F.sum("df").alias("df"))
        _write(counts.withColumn("batch_id", F.lit(batch_id)), f"{root}/counts")
    return write


def start_segments(spark: SparkSession, source_path: str, schema: T.StructType, path: str,
                   checkpoint_location: str, id_col: str = "doc_id",
                   text_cols: list[str] | None = None, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None, available_now: bool = True,
                   version_col: str | None = None, payload_cols: list[str] | None = None,
                   ) -> StreamingQuery:
    """Start the stream that writes segments (``availableNow`` drains what exists, then stops).

    An id keeps its row of the greatest ``version_col``, whatever batch brought it (ties:
    the newer batch, then the greater text); without one, the row of its newest batch.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    write = _segment_writer(path.rstrip("/"), id_col, text_cols or ["text"], version_col,
                            list(payload_cols or []))
    writer = (reader.load(source_path).writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def segment_index(spark: SparkSession, path: str) -> TextIndex:
    """The index over the complete segments, weighed with their summed df and N."""
    segments = Segments(spark, path)
    rows, counts = segments.live(), segments.counts()
    if rows is None:
        raise FileNotFoundError(f"no segment under {path}")
    payload = [c for c in rows.columns if c not in ("doc_id", "_ver", "batch_id", "terms")]
    n_docs = counts.where(F.col("dim") == N_DIM).select(F.col("df").alias("n"))
    dfreq = counts.where((F.col("dim") != N_DIM) & (F.col("df") > 0))
    return _assemble(rows.select("doc_id", "terms"), n_docs, rows.select("doc_id", *payload),
                     payload, None, dfreq)


def compact_segments(spark: SparkSession, path: str) -> int:
    """Merge the complete segments into a new base; returns its newest batch id (-1: none).

    The base is read only once its publication, the last step, is complete.  Segments that
    it covers are not read any more and stay until they are removed by hand.
    """
    segments = Segments(spark, path)
    rows, counts = segments.live(), segments.counts()
    if rows is None:
        return -1
    top = segments.tail[-1] if segments.tail else segments.top
    build = f"{new_build().split('-')[0]}-{top:08x}"
    base = f"{segments.root}/build={build}"
    _write(rows.withColumn("batch_id", F.lit(top)), f"{base}/terms")
    _write(counts.where("df <> 0").withColumn("batch_id", F.lit(top)), f"{base}/counts")
    publish(spark, segments.root, build)
    return top
