"""Per-tenant marks and layout: a mark for every tenant, kept as a table.

Marks are rows of an append-only JSON table (tenant, mark, run_id); a tenant's mark is
the greatest.  They are joined into the scan, never turned into one literal per tenant,
so thousands of tenants cost one small join.  The lake is partitioned by tenant and
date; readers that join a table of tenants prune its partitions at run time.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefmt import as_utc, iso_text, parse_iso
from tidemark.operators.versions import latest_version
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.lake import _path_exists
from tidemark.sources.tables import mark_literal

MARK_SCHEMA = T.StructType([T.StructField("tenant", T.StringType()),
                            T.StructField("mark", T.StringType()),
                            T.StructField("run_id", T.StringType())])
BROADCAST_TENANTS = 500_000      # about 40 bytes each


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """(tenant as text, mark): the greatest readable mark of every tenant."""
    if not _path_exists(spark, path):
        return spark.createDataFrame([], "tenant string, mark timestamp")
    rows = spark.read.schema(MARK_SCHEMA).json(path)
    return rows.groupBy("tenant").agg(F.max(parse_iso("mark")).alias("mark")).where(
        F.col("mark").isNotNull())


def write_marks(marks: DataFrame, path: str, run_id: str) -> None:
    """Append the marks of all tenants in one job; a repeated write changes nothing."""
    (marks.select(F.col("tenant").cast("string").alias("tenant"), iso_text("mark").alias("mark"),
                  F.lit(run_id).alias("run_id"))
     .write.mode("append").json(path))


def tenant_delta(source: DataFrame, marks: DataFrame, tenant: str, ts: str) -> DataFrame:
    """Rows newer than their own tenant's mark; all rows of tenants without one.

    Tenants with a mark are read behind the least mark of all, a literal that reaches the
    scan, and then compared with their own.  Rows without a time or a tenant are in no delta.
    """
    low, n = marks.agg(iso_text(F.min("mark")), F.count(F.lit(1))).first()
    small = F.broadcast(marks) if n <= BROADCAST_TENANTS else marks
    key = F.col(tenant).cast("string") == F.col("tenant")
    rows = source.where(F.col(tenant).isNotNull() & F.col(ts).isNotNull())
    fresh = rows.join(small, key, "left_anti")
    if low is None:
        return fresh
    known = rows.where(F.col(ts) > mark_literal(datetime.fromisoformat(low), source.schema[ts].dataType))
    known = known.join(small, key).where(as_utc(ts) > F.col("mark")).select(*source.columns)
    return known.unionByName(fresh)


def tenant_marks(delta: DataFrame, tenant: str, ts: str) -> DataFrame:
    """(tenant, mark) after a delta: one partial aggregate, a hot tenant costs a row per task."""
    return delta.groupBy(F.col(tenant).cast("string").alias("tenant")).agg(
        F.max(as_utc(ts)).alias("mark"))


def _lake_rows(delta: DataFrame, tenant: str, ts: str) -> DataFrame:
    date = F.date_format(as_utc(ts), "yyyy-MM-dd")
    return delta.withColumn("tenant", F.col(tenant).cast("string")).withColumn("date", date)


def write_tenant_lake(delta: DataFrame, path: str, tenant: str, key: str, ts: str) -> None:
    """Merge a delta into ``<path>/tenant=../date=../*.parquet``.

    Touched (tenant, date) folders get their stored rows and the delta's, the newest row of
    each key.  The stored side is read through a join with the touched pairs, so other
    partitions are not opened.  The merged rows go to the shared checkpoint folder before
    the overwrite, and are dealt by ranges of (tenant, date, time): a hot tenant is spread over tasks.
    """
    spark = delta.sparkSession
    ensure_checkpoint_dir(spark)
    new = _lake_rows(delta, tenant, ts).checkpoint()
    both = new
    if _path_exists(spark, path):
        touched = new.select("tenant", "date").distinct()
        old = read_tenant_lake(spark, path).join(F.broadcast(touched) if touched.count() <= BROADCAST_TENANTS
                                                 else touched, ["tenant", "date"], "left_semi")
        both = new.unionByName(old.select(*new.columns))
    merged = latest_version(both, [key, "tenant", "date"], [ts]).checkpoint()
    (merged.repartitionByRange("tenant", "date", ts).sortWithinPartitions("tenant", "date", ts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("tenant", "date").parquet(path))


def read_tenant_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake with ``tenant`` and ``date`` as text."""
    return (spark.read.option("basePath", path).parquet(path)
            .withColumn("tenant", F.col("tenant").cast("string"))
            .withColumn("date", F.col("date").cast("string")))


def run_tenant_ingest(spark: SparkSession, source: DataFrame, tenant: str, key: str, ts: str,
                      lake_path: str | None, marks_path: str) -> str:
    """One incremental run over all tenants; the marks move last.  Returns the run id.

    A failed run is repeated as it is: marks have not moved and the merge is idempotent.
    ``lake_path=None`` moves marks only.
    """
    run_id = str(uuid.uuid4())
    ensure_checkpoint_dir(spark)
    delta = tenant_delta(source, read_marks(spark, marks_path), tenant, ts).checkpoint()
    if delta.isEmpty():
        return run_id
    if lake_path:
        write_tenant_lake(delta, lake_path, tenant, key, ts)
    write_marks(tenant_marks(delta, tenant, ts), marks_path, run_id)
    return run_id
