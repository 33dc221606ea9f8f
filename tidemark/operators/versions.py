"""Latest-version view (one row per key) and late-row audits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefmt import as_utc


def latest_version(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_cols`` (lexicographic).

    Expressed as ``max(struct(order..., rest...))`` per key: a partial
    aggregate, so each task keeps one candidate per key before the shuffle.
    A key holding a third of all rows costs one row per task, not one
    task holding the whole group (as a ``row_number`` window would).
    Remaining columns break exact ties deterministically.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in df.columns if c not in keys]) \
        .select(*df.columns)


def late_rows(source: DataFrame, lake: DataFrame, key: str, ts_col: str,
              mark) -> DataFrame:
    """Source rows at or below the mark that the lake does not hold.

    A strict ``ts > mark`` delta never re-reads these (rows committed late
    with an older timestamp, or rows lost by a partition replace).  A
    ``left_anti`` join on ``(key, ts)``; both sides are pruned to the
    columns and the ``ts <= mark`` range first.
    """
    src = source.where(F.col(ts_col) <= F.lit(mark))
    have = lake.select(key, ts_col).where(F.col(ts_col) <= F.lit(mark))
    return src.join(have, [key, ts_col], "left_anti")


@dataclass(frozen=True)
class DigestAudit:
    """``rows``: the late rows; ``differ``: the dates read row by row; ``dates``: all compared."""

    rows: DataFrame
    differ: list[str]
    dates: int


def date_digests(df: DataFrame, key: str, ts_col: str) -> DataFrame:
    """``(date, n, digest)``: an order-free digest of (key, time) of every date.

    Sums of two independent 64-bit hashes per row, exact in decimals: the same rows in any
    order, file layout or partitioning give the same digest.  One partial aggregate.
    """
    micros = F.unix_micros(as_utc(ts_col))
    total = [F.sum(F.xxhash64(F.lit(seed), F.col(key), micros).cast("decimal(38,0)")) for seed in (1, 2)]
    return df.groupBy(F.date_format(as_utc(ts_col), "yyyy-MM-dd").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.concat_ws(":", *total).alias("digest"))


def late_rows_by_digest(source: DataFrame, lake: DataFrame, key: str, ts_col: str, mark,
                        lake_date: str = "date") -> DigestAudit:
    """:func:`late_rows`, joining only the dates whose digests differ.

    Both sides are aggregated to a row per date first, and those are compared (dates are
    bounded by the calendar); the anti-join then reads the source behind its time range
    and the lake behind ``lake_date IN (...)``, its partition column.  A date that both sides
    hold alike is never joined.  A lake that stores a (key, time) twice differs from its
    source and is joined; the answer is the same.
    """
    bound = F.lit(mark)
    src = source.where(F.col(ts_col) <= bound)
    have = lake.where(F.col(ts_col) <= bound)
    both = date_digests(src, key, ts_col).join(
        date_digests(have, key, ts_col).select("date", F.col("n").alias("_n"), F.col("digest").alias("_d")),
        "date", "left")
    same = (F.col("n") == F.coalesce("_n", F.lit(0))) & (F.col("digest") == F.coalesce("_d", F.lit("")))
    seen = both.select("date", same.alias("same")).collect()
    differ = sorted(r["date"] for r in seen if not r["same"])
    day = F.date_format(as_utc(ts_col), "yyyy-MM-dd")
    rows = late_rows(src.where(day.isin(differ)), have.where(F.col(lake_date).isin(differ)), key, ts_col, mark)
    return DigestAudit(rows, differ, len(seen))
