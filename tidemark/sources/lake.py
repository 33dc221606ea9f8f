"""Date-partitioned JSON-lines lake: write (replace / merge) and read.

Layout: ``<root>/<table>/date=YYYY-MM-DD/part-*.json``.  A row's partition
is the UTC date of its own timestamp (not the run date).  Timestamps are
stored as exact ISO-8601 text (microseconds kept) so a strict ``>`` mark
round-trips.

Write modes:

* ``replace``: touched dates are replaced by the delta only (dynamic
  partition overwrite).  Rows of a touched date that are not re-delivered
  are lost: this is the in-memory service's behaviour, kept for parity.
* ``merge`` (default): touched dates get their stored rows plus the delta,
  one row per (key, date), the greatest timestamp winning and the delta
  winning ties.  The merge works on whole lines: a stored line is kept or
  replaced as it is, and lines without a readable key stay verbatim.  The
  merged lines are written to the shared checkpoint folder first, so the
  overwrite never reads the files it replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefmt import as_utc, iso_text, parse_iso
from tidemark.operators.versions import latest_version
from tidemark.session import ensure_checkpoint_dir

CORRUPT = "_corrupt_record"
LINE = "_line"


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def partition_paths(root: str, table: str, dates: list[str]) -> list[str]:
    return [f"{table_path(root, table)}/date={d}" for d in sorted(dates)]


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _has_rows(spark: SparkSession, path: str) -> bool:
    """A partition folder with a data file: what a failed first write leaves is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/date=*/[^_.]*")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def lake_rows(delta: DataFrame, ts_col: str) -> DataFrame:
    """Source rows as lake rows: timestamps as ISO text, plus ``date``."""
    cols = []
    for f in delta.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(iso_text(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    date = F.date_format(as_utc(ts_col), "yyyy-MM-dd").alias("date")
    return delta.select(*cols, date)


def _write(rows: DataFrame, path: str, ts_col: str) -> None:
    # Range-partition on (date, ts): balanced files even when one date holds
    # most rows, few files per date, and lines ascending by timestamp.
    (rows.repartitionByRange("date", ts_col)
     .sortWithinPartitions("date", ts_col)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("date")
     .json(path))


def _merged_lines(spark: SparkSession, new: DataFrame, path: str, key: str, ts_col: str,
                  dates: list[str]) -> DataFrame:
    """Stored and new lines of the touched dates: ``(date, _ts, value)``.

    One line per (key, date); lines whose key is missing or unreadable are
    not comparable and all stay."""
    fields = [c for c in new.columns if c != "date"]
    kind = new.schema[key].dataType
    old = (spark.read.option("basePath", path).text(path)
           .withColumn("date", F.col("date").cast("string"))
           .where(F.col("date").isin(sorted(dates)) & (F.trim("value") != "")))
    seen = F.from_json("value", T.StructType([T.StructField(key, T.StringType()),
                                              T.StructField(ts_col, T.StringType())]))
    old = old.select("date", seen[key].try_cast(kind).alias("_key"),
                     parse_iso(seen[ts_col]).alias("_ts"), "value", F.lit(0).alias("_new"))
    fresh = new.select("date", F.col(key).alias("_key"), parse_iso(ts_col).alias("_ts"),
                       F.to_json(F.struct(*fields)).alias("value"), F.lit(1).alias("_new"))
    both = fresh.unionByName(old)
    named = latest_version(both.where("_key is not null"), ["_key", "date"], ["_ts", "_new"])
    return (named.unionByName(both.where("_key is null"))
            .select("date", "_ts", "value"))


def write_table(spark: SparkSession, delta: DataFrame, root: str, table: str, key: str,
                ts_col: str, dates: list[str], mode: str = "merge") -> list[str]:
    """Write a delta into the lake; return the touched partition folders."""
    if mode not in ("merge", "replace"):
        raise ValueError(f"unknown lake write mode {mode!r}")
    path = table_path(root, table)
    new = lake_rows(delta, ts_col)
    if mode == "merge" and dates and _has_rows(spark, path):
        merged = _merged_lines(spark, new, path, key, ts_col, dates)
        ensure_checkpoint_dir(spark)
        staged = merged.checkpoint(eager=True)
        (staged.repartitionByRange("date", "_ts").sortWithinPartitions("date", "_ts")
         .select("date", "value").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("date").text(path))
    else:
        _write(new, path, ts_col)
    return partition_paths(root, table, dates)


def read_raw(spark: SparkSession, root: str, table: str,
             schema: T.StructType | None = None) -> DataFrame:
    """Lake rows exactly as stored (strings for every non-numeric column)."""
    path = table_path(root, table)
    reader = spark.read.option("basePath", path)
    if schema is not None:
        fields = [f for f in schema.fields if f.name != "date"]
        reader = reader.schema(T.StructType(fields))
    df = reader.json(path)
    return df.withColumn("date", F.col("date").cast("string"))


def read_lake(spark: SparkSession, root: str, table: str, schema: T.StructType,
              required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Read a lake table with validation: ``(good, quarantine)``.

    Every field is parsed as text (once, in the scan; blank lines are
    skipped), then cast with ``try_cast`` (so ``"7"`` in a bigint field is
    accepted, as a lenient model would).  Lines that do not parse go to the
    quarantine frame as their raw text; lines that lack a required field go
    there re-serialised.
    """
    path = table_path(root, table)
    text_schema = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema.fields if f.name != "date"]
        + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.option("basePath", path).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).schema(text_schema).json(path))
    fields = [f for f in schema.fields if f.name != "date"]
    typed = []
    for f in fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            typed.append(parse_iso(c).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            typed.append(c)
        else:
            typed.append(c.try_cast(f.dataType).alias(f.name))
    ok = F.col(CORRUPT).isNull()
    for r in required:
        ok = ok & F.col(f"_t.{r}").isNotNull()
    # one parse (in the scan); the line text is kept for lines that do not
    # parse, and re-serialised for lines that parse but miss a required field
    cast = raw.select(F.struct(*typed).alias("_t"), F.col("date").cast("string").alias("date"),
                      CORRUPT, F.to_json(F.struct(*[F.col(f.name) for f in fields])).alias(LINE))
    cast = cast.withColumn("_ok", ok)
    good = cast.where("_ok").select("_t.*", "date")
    bad = cast.where(~F.col("_ok")).select("date", F.coalesce(CORRUPT, LINE).alias("raw"))
    return good, bad


def compact(spark: SparkSession, root: str, table: str, schema: T.StructType,
            required: list[str], out_path: str, dates: list[str] | None = None,
            ts_col: str | None = None, quarantine_path: str | None = None) -> DataFrame:
    """Rewrite lake partitions as Parquet, one sorted set of files per date.

    Rows are sorted by ``ts_col`` (by default the first timestamp, else by date
    alone).  Lines that cannot be read are kept as text under ``quarantine_path``,
    by default next to ``out_path``."""
    good, bad = read_lake(spark, root, table, schema, required)
    if dates:
        good = good.where(F.col("date").isin(sorted(dates)))
        bad = bad.where(F.col("date").isin(sorted(dates)))
    (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").text(quarantine_path or f"{out_path.rstrip('/')}_quarantine"))
    times = [f.name for f in schema.fields
             if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    ts = ts_col or (times[0] if times else "date")
    (good.repartitionByRange("date", ts).sortWithinPartitions("date", ts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(out_path))
    return spark.read.parquet(out_path)
