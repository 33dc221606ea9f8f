"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

#: Set only where the launcher set nothing.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark") -> SparkSession:
    """Session for the library's jobs.

    What the launcher set (spark-submit, PYSPARK_SUBMIT_ARGS, defaults file)
    is kept; the values here only fill gaps.  Without ``shuffle_partitions``
    that setting is never touched.  Driver memory and the UI switch are only
    given where this call starts the JVM itself, on a local master.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    starts_jvm = "PYSPARK_GATEWAY_PORT" not in os.environ and SparkContext._gateway is None
    if starts_jvm and (master or "").startswith("local"):
        if not re.search(r"driver[-.]memory", submitted):
            builder = builder.config("spark.driver.memory",
                                     os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        for key in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            if key not in submitted:
                builder = builder.config(key, "false")
    spark = builder.getOrCreate()
    wanted = dict(DEFAULTS)
    if shuffle_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    given = spark.sparkContext.getConf()
    for key, value in wanted.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")    # part of the semantics
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; we never
    override it.  Local masters get a fresh folder under /tmp; on any other
    master a missing setting is an error, since /tmp is not shared there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Jobs that need to materialise an intermediate table (lake folders in
    the registered queries, cut lineage) write here, never to a
    machine-local temp dir, so lost executors can re-read the data.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the library's semantics rely on, for a session made elsewhere.

    Timestamps without zone are UTC wall time and partition dates are UTC
    dates, so the session time zone is fixed to UTC; the shared checkpoint
    folder is set only if the session has none.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark
