"""Range buckets from literal boundaries.

Boundaries are computed once and used as literals, so a bucket number is a pure
function of the value: re-evaluating a frame (another branch, a retry, other
adaptive settings) can never move a row to another bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_bounds(df: DataFrame, col: str, buckets: int) -> list[int]:
    """Ascending distinct values of integer column ``col``, one upper bound per bucket.

    Every bound is a value of the column and the last one is its maximum, so
    no bucket of ``range_bucket`` is empty.  Empty list: no non-null value."""
    if buckets < 1:
        raise ValueError("buckets must be positive")
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)] or [F.lit(0.0)])
    row = df.agg(F.percentile_approx(F.col(col).cast("long"), cuts, F.lit(max(10_000, 10 * buckets)))
                 .alias("cuts"), F.max(F.col(col).cast("long")).alias("top")).first()
    if row["top"] is None:
        return []
    inner = row["cuts"] if buckets > 1 else []
    return sorted({*inner, row["top"]})


def range_bucket(value: Column, bounds: list[int]) -> Column:
    """Number of bounds below ``value`` (0 for the lowest bucket); null stays null.

    A binary search over a literal array: log2(len(bounds)) steps per row."""
    steps, step = [], 1
    while step <= len(bounds):
        steps.append(step)
        step *= 2
    if not steps:
        return F.when(value.isNotNull(), F.lit(0))
    table = F.lit(bounds)
    found = F.aggregate(
        F.array(*map(F.lit, reversed(steps))), F.lit(0),
        lambda at, s: F.when((at + s <= len(bounds))
                             & (F.element_at(table, F.least(at + s, F.lit(len(bounds)))) < value),
                             at + s).otherwise(at))
    return F.when(value.isNotNull(), found)
