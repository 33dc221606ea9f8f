"""Data-quality checks as aggregates and anti-joins.

Each check returns violation rows or one summary row per rule, computed
in one pass (null and domain counts are a single aggregate over all
columns; uniqueness is a partial aggregate on the key; foreign keys are a
``left_anti`` join on the key columns only, which Catalyst prunes to).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """``(table, column, violations)``: NULLs per column, one scan."""
    cols = columns or df.columns
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c)
                   for c in cols])
    stacked = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).alias("violations"))
        for c in cols])).alias("s"))
    return stacked.select(F.lit(table).alias("table"), "s.column", "s.violations")


def domain_violations(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose ``column`` is null or outside ``allowed``."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(allowed))


def domain_counts(df: DataFrame, table: str, rules: dict[str, list[str]]) -> DataFrame:
    """``(table, column, violations)`` for several domain rules, one scan."""
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull() | ~F.col(c).isin(v), 1).otherwise(0))
                   .cast("long").alias(c) for c, v in rules.items()])
    rows = [agg.select(F.lit(table).alias("table"), F.lit(c).alias("column"),
                       F.coalesce(F.col(c), F.lit(0)).alias("violations")) for c in rules]
    return reduce(DataFrame.unionByName, rows)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n"))
            .where(F.col("n") > 1))


def unique_summary(df: DataFrame, table: str, key: str) -> DataFrame:
    """``(table, column, duplicate_keys, duplicate_rows)``."""
    d = duplicate_keys(df.select(key), [key])
    return d.agg(F.count(F.lit(1)).cast("long").alias("duplicate_keys"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows")).select(
        F.lit(table).alias("table"), F.lit(key).alias("column"), "duplicate_keys",
        "duplicate_rows")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    p = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")


def foreign_key_summary(child: DataFrame, parent: DataFrame, child_table: str,
                        child_key: str, parent_table: str, parent_key: str) -> DataFrame:
    """Orphan count.  The child is first reduced to ``(key, rows)`` by a
    partial aggregate, so a hot key costs one row per task and only
    distinct keys reach the anti-join shuffle."""
    keys = (child.where(F.col(child_key).isNotNull())
            .groupBy(child_key).agg(F.count(F.lit(1)).alias("_rows")))
    o = orphans(keys, parent, child_key, parent_key)
    return o.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orphans")).select(
        F.lit(child_table).alias("child"), F.lit(child_key).alias("child_key"),
        F.lit(parent_table).alias("parent"), "orphans")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Bag equality of two DataFrames (``exceptAll`` both ways is empty)."""
    cols = sorted(a.columns)
    if cols != sorted(b.columns):
        return False
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
