"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_udf(fn: Callable[[str | None], object], returns: str):
    """An Arrow-batched scalar function of one text column (None for null)."""

    @F.pandas_udf(returns)
    def apply(col: pd.Series) -> pd.Series:
        return pd.Series([fn(x) for x in col.tolist()], dtype=object)

    return apply


def slices(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, cut so that a text column holds about ``most`` bytes.

    A longer text is a slice of its own: what a task keeps in Python does not grow with
    the number of rows that Spark puts into a batch."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False),
                     dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text mod 5 is 0; a null id counts as empty text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5) == 0


def hash_unit(*cols: Column, seed: str) -> Column:
    """A number in [0, 1) from md5 of the columns: equal on every engine."""
    parts = [F.lit(seed)] + [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number reachable from each of n nodes (hook and jump)."""
    label = np.arange(n)
    while True:
        ra, rb = label[a], label[b]
        apart = ra != rb
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long).

    Alternating large-star / small-star rounds; every round is a partial
    aggregate plus a join on the node, checkpointed, so nothing but two
    numbers per round reaches the driver.  root is the smallest node of the
    component.  Nulls and self-loops are ignored.
    """
    e = materialise(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(e)
    for _ in range(max_rounds):
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (sym.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("p")).select("p.*").where("u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        e = materialise(small)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def ball(width: int, radius: int) -> np.ndarray:
    """All bit masks of ``width`` bits with at most ``radius`` bits set."""
    masks: list[int] = [0] if radius >= 0 else []
    layer: Iterable[tuple[int, int]] = [(0, 0)] if radius >= 0 else []
    for _ in range(max(0, radius)):
        layer = [(m | 1 << i, i + 1) for m, at in layer for i in range(at, width)]
        masks += [m for m, _ in layer]
    return np.array(masks, dtype=np.int64)
