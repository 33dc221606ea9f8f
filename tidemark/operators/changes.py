"""Keyed change sets: update by key, insert with new dense ids.

``apply_change_set(target, updates, inserts, key)``:

* updates carry an existing key and change the columns they give, no other;
* inserts carry no key; they get ``max(key) + 1, + 2, ...`` in a given
  order, like an identity column.

Dense ids are assigned without a global single-task window: the inserts
are range-partitioned on the order columns and staged once, with their
partition number, in the shared checkpoint folder; each partition then
numbers its rows locally, and a prefix sum over the per-partition counts
(one row per partition) gives each partition's offset.  Staging matters:
a partition number taken from a frame that is evaluated again can differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def dense_ids(df: DataFrame, order_cols: list[str], start, out: str = "id") -> DataFrame:
    """Add ``out`` = start + 1, start + 2, ... following ``order_cols``.

    ``start`` is a number or a one-value Column (e.g. a scalar subquery).
    Rows that tie on ``order_cols`` are ordered by a hash of the whole row.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(*order_cols).withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    local = ranged.withColumn("_i", F.row_number().over(
        Window.partitionBy("_pid").orderBy(*order_cols, F.xxhash64(*df.columns))))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded, broadcastable table
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n"))
                            .alias("_off"))
    base = start if hasattr(start, "_jc") else F.lit(start)
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (base + F.col("_off") + F.col("_i")).cast("long"))
            .drop("_pid", "_i", "_off"))


class RepeatedKeys(ValueError):
    """A change set that updates one key more than once: no order is given."""


def merge_updates(target: DataFrame, updates: DataFrame, key: str,
                  given_col: str | None = None) -> DataFrame:
    """``target`` with ``updates`` applied by key, plus ``_updated`` (boolean).

    An update changes the columns it gives and no other.  By default every column of
    ``updates`` is given, NULL values included (``SET c = NULL``); columns that it does
    not have are kept.  ``given_col`` names an array<string> column of ``updates`` that
    lists, row by row, the columns given; a NULL list gives all.

    Updates whose key is not in the target, or NULL, touch no row; target rows with a
    NULL key are never updated.  A target key that occurs twice is updated in both rows.
    One join: the target is read once.  Two updates of one key raise
    :class:`RepeatedKeys`, found by one aggregate over the updates.
    """
    repeated = (updates.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
                .select(key).orderBy(key).limit(5).collect())
    if repeated:
        raise RepeatedKeys(f"updated more than once: {[r[0] for r in repeated]}")
    named = [c for c in target.columns if c in updates.columns and c != key]
    unknown = [c for c in updates.columns if c not in target.columns and c != given_col]
    if unknown:
        raise ValueError(f"columns that the target does not have: {unknown}")
    side = updates.select(F.col(key).alias("_key"), F.lit(True).alias("_hit"),
                          *([F.col(given_col).alias("_given")] if given_col else []),
                          *[F.col(c).alias(f"_new_{c}") for c in named])
    joined = target.join(side, F.col(key) == F.col("_key"), "left")
    hit = F.coalesce("_hit", F.lit(False))

    def column(c: str):
        if c not in named:
            return F.col(c)
        given = hit
        if given_col:
            given = hit & F.coalesce(F.array_contains("_given", c), F.lit(True))
        new = F.col(f"_new_{c}").cast(target.schema[c].dataType)
        return F.when(given, new).otherwise(F.col(c)).alias(c)

    return joined.select(*[column(c) for c in target.columns], hit.alias("_updated"))


def apply_change_set(target: DataFrame, updates: DataFrame, inserts: DataFrame, key: str,
                     order_cols: list[str], flag: str | None = "change",
                     given_col: str | None = None) -> DataFrame:
    """The target after the change set, optionally flagged keep/update/insert.

    Updates follow :func:`merge_updates`.  Columns missing from inserts are NULL.
    """
    cols = target.columns
    merged = merge_updates(target, updates, key, given_col)
    start = target.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    ins = dense_ids(inserts, order_cols, start, key)
    ins = ins.select(*[F.col(c) if c in ins.columns else F.lit(None).cast(t).alias(c)
                       for c, t in target.dtypes])
    if not flag:
        return merged.select(*cols).unionByName(ins)
    tagged = F.when(F.col("_updated"), F.lit("update")).otherwise(F.lit("keep")).alias(flag)
    return merged.select(*cols, tagged).unionByName(ins.withColumn(flag, F.lit("insert")))
