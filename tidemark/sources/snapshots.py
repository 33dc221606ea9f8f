"""Lake tables with snapshots: whole versions, published by one pointer.

Layout under ``<root>/<table>``::

    data/commit=<id>/date=<day>/part-*.json   rows; a commit's folders never change
    versions/<n>.json                         one version: {"parent", "commit", "dates": {day: commit}}

A version names, for every date, the commit that holds its rows.  A writer adds a commit
with the dates it touches and then claims version n + 1 by renaming a finished file to its
name, which fails if the name is taken.  Readers take the highest version, so they see a
version's dates together or not at all, whatever happens to a writer; earlier versions
stay readable.  A writer that loses the race starts again from the winner's version if
that touched one of its dates, and otherwise only carries its dates over to it.

The map holds one entry for each date, bounded by the calendar.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefmt import parse_iso
from tidemark.operators.versions import latest_version
from tidemark.sources.lake import lake_rows, table_path

Hook = Callable[[str], None]
DIGITS = 12


class Conflict(RuntimeError):
    """Other writers kept publishing the same dates first."""


@dataclass(frozen=True)
class Version:
    number: int                       # 0: no version yet
    dates: dict[str, str]             # date -> commit
    commit: str | None = None
    parent: int = 0


class _Files:
    """The few file operations a version needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self.fs.create(self.path(path), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def claim(self, source: str, target: str) -> bool:
        """Rename to a name that is free; False if another writer has it."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.path(target).getFileSystem(self.conf).getUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.path(source), self.path(target), none)
            return True
        except Exception as error:                    # py4j wraps what the JVM throws
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def modified(self, path: str) -> int:
        return self.fs.getFileStatus(self.path(path)).getModificationTime()


def _versions(files: _Files, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in files.names(f"{path}/versions")
                  if n.endswith(".json") and n[:-5].isdigit())


def version(spark: SparkSession, root: str, table: str, number: int | None = None) -> Version:
    """The newest version, or the one of that number."""
    path = table_path(root, table)
    files = _Files(spark, path)
    found = _versions(files, path)
    if number is None:
        if not found:
            return Version(0, {})
        number = found[-1]
    elif number not in found:
        raise FileNotFoundError(f"no version {number} of {path}")
    raw = json.loads(files.read(f"{path}/versions/{number:0{DIGITS}d}.json"))
    return Version(number, raw["dates"], raw["commit"], raw["parent"])


def read_snapshot(spark: SparkSession, root: str, table: str, schema: T.StructType,
                  number: int | None = None, dates: list[str] | None = None) -> DataFrame:
    """Rows of one version as stored (times as ISO text), with ``date``.

    ``dates`` restricts the read to folders of those dates.  No version: no rows.
    """
    at = version(spark, root, table, number)
    path = table_path(root, table)
    folders = [f"{path}/data/commit={c}/date={d}" for d, c in sorted(at.dates.items())
               if dates is None or d in dates]
    fields = T.StructType([f for f in schema.fields if f.name not in ("date", "commit")])
    full = T.StructType([*fields.fields, T.StructField("commit", T.StringType()),
                         T.StructField("date", T.StringType())])
    if not folders:
        return spark.createDataFrame([], full).drop("commit")
    return (spark.read.option("basePath", f"{path}/data").schema(full).json(folders)
            .drop("commit"))


def write_snapshot(spark: SparkSession, delta: DataFrame, root: str, table: str, key: str,
                   ts_col: str, dates: list[str], mode: str = "merge", attempts: int = 5,
                   hook: Hook | None = None) -> Version:
    """Publish a new version with a delta; the touched dates are replaced or merged.

    ``merge`` keeps, for each (key, date), the row of the greatest time, the delta's on
    ties.  ``hook`` is called with the name of every step (``read``, ``written``,
    ``ready``, ``published``), for tests of failures.  A failure before ``published``
    leaves the table as it was; the same write can then be repeated.
    """
    if mode not in ("merge", "replace"):
        raise ValueError(f"unknown write mode {mode!r}")
    if not dates:
        return version(spark, root, table)
    path = table_path(root, table)
    files = _Files(spark, path)
    told = hook or (lambda step: None)
    new = lake_rows(delta, ts_col).where(F.col("date").isin(sorted(dates)))
    based: Version | None = None
    commit = ""
    for _ in range(attempts):
        now = version(spark, root, table)
        told("read")
        if based is None or any(now.dates.get(d) != based.dates.get(d) for d in dates):
            commit, based = uuid.uuid4().hex, now
            rows = new
            if mode == "merge" and any(d in now.dates for d in dates):
                old = read_snapshot(spark, root, table, new.schema, now.number or None, dates)
                both = (new.withColumn("_new", F.lit(1))
                        .unionByName(old.select(*new.columns).withColumn("_new", F.lit(0)))
                        .withColumn("_ts", parse_iso(ts_col)))
                rows = latest_version(both, [key, "date"], ["_ts", "_new"]).drop("_ts", "_new")
            (rows.repartitionByRange("date", ts_col).sortWithinPartitions("date", ts_col)
             .write.partitionBy("date").json(f"{path}/data/commit={commit}"))
            told("written")
        mine = {d: commit for d in dates
                if files.fs.exists(files.path(f"{path}/data/commit={commit}/date={d}"))}
        body = {"parent": now.number, "commit": commit, "dates": {**now.dates, **mine}}
        ready = f"{path}/versions/.{uuid.uuid4().hex}.tmp"
        files.write(ready, json.dumps(body, sort_keys=True))
        told("ready")
        if files.claim(ready, f"{path}/versions/{now.number + 1:0{DIGITS}d}.json"):
            told("published")
            return Version(now.number + 1, body["dates"], commit, now.number)
        files.delete(ready)
    raise Conflict(f"{path}: lost {attempts} races")


def snapshot_writer(spark: SparkSession, delta: DataFrame, root: str, table: str, key: str,
                    ts_col: str, dates: list[str], mode: str = "merge") -> list[str]:
    """The lake writer of an ingest run (``run_ingest(writer=snapshot_writer)``)."""
    done = write_snapshot(spark, delta, root, table, key, ts_col, dates, mode)
    return [f"{table_path(root, table)}/data/commit={done.dates[d]}/date={d}" for d in sorted(dates)]


def expire(spark: SparkSession, root: str, table: str, keep: int = 10,
           older_than_ms: int = 24 * 3600 * 1000) -> list[str]:
    """Drop all but the newest ``keep`` versions and the commits that none of those names.

    Commits younger than ``older_than_ms`` stay even if no version names them: a writer may
    be about to publish one.  Returns the commits removed.
    """
    if keep < 1:
        raise ValueError("keep one version at least")
    path = table_path(root, table)
    files = _Files(spark, path)
    numbers = _versions(files, path)
    named = {c for n in numbers[-keep:] for c in version(spark, root, table, n).dates.values()}
    now = int(files.jvm.java.lang.System.currentTimeMillis())
    gone = []
    for n in numbers[:-keep]:
        files.delete(f"{path}/versions/{n:0{DIGITS}d}.json")
    for folder in files.names(f"{path}/data"):
        commit = folder.removeprefix("commit=")
        if commit not in named and now - files.modified(f"{path}/data/{folder}") >= older_than_ms:
            files.delete(f"{path}/data/{folder}")
            gone.append(commit)
    return sorted(gone)
