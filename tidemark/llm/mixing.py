"""Mixing sources to target weights by Poisson replication.

Source s with mass m_s (sum of text lengths) and target weight w_s gets the mean
repetition rate r_s = w_s * budget / m_s.  Every document draws its number of
copies by inverting the Poisson distribution of that mean at a number hashed from
(seed, id, text), so a rerun, a lost executor or another engine draws the same
copies.  Copies are dealt to partitions by a hash of (seed, id, text, copy) and sorted by
it there: a global shuffle without a driver-side permutation.

Defined cases: a null source is a source of its own; null texts have length 0; a
source without mass (only empty texts) has rate 0; repeated rows draw the same
number, each for itself; weights need not sum to 1; a source missing from given
weights has weight 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hash_unit, materialise, shuffle_partitions

MAX_BROADCAST_BYTES = 64 << 20    # above this the rates are joined by shuffle


def source_rates(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source",
                 text_col: str = "text", alpha: float = 0.5, budget: float = 1.0) -> DataFrame:
    """(source, n_docs, mass, weight, rate).

    ``weights`` (source, weight) are the targets; without it they are mass**alpha
    (normalised).  ``budget``: output mass as a multiple of the input's."""
    mass = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.coalesce(F.length(text_col), F.lit(0))).cast("double").alias("mass"))
    mass = materialise(mass)
    if weights is None:
        raw = mass.withColumn("weight", F.when(F.col("mass") > 0, F.pow("mass", F.lit(alpha)))
                              .otherwise(F.lit(0.0)))
    else:
        given = weights.select(F.col("source").alias("__s"), F.col("weight").cast("double"))
        raw = (mass.join(given, mass["source"].eqNullSafe(given["__s"]), "left")
               .drop("__s").withColumn("weight", F.coalesce("weight", F.lit(0.0))))
    raw = materialise(raw)
    total = raw.agg(F.sum("weight").alias("w"), F.sum("mass").alias("m")).first()
    scale = (total["m"] or 0.0) * budget / (total["w"] or 1.0)
    return raw.withColumn("rate", F.when(F.col("mass") > 0, F.col("weight") * F.lit(scale)
                                         / F.col("mass")).otherwise(F.lit(0.0)))


def poisson_table(rate: float) -> tuple[int, np.ndarray]:
    """(low, P(N <= k) for k = low, low + 1, ...), long enough for 53-bit numbers.

    Terms are taken outward from the mode by their ratios, in log space, within 12 standard
    deviations and 40 (what lies outside is below the resolution of a draw): the table
    grows with the root of the rate, and so does its cost.
    """
    if not rate > 0:
        return 0, np.ones(1)
    mode, reach = math.floor(rate), math.ceil(12 * math.sqrt(rate) + 40)
    low = max(0, mode - reach)
    up = np.log(rate) - np.log(np.arange(mode + 1, mode + reach + 1, dtype=np.float64))
    down = np.log(np.arange(mode, low, -1, dtype=np.float64)) - np.log(rate)
    logs = np.concatenate([np.cumsum(down)[::-1], [0.0], np.cumsum(up)])
    at_mode = mode * math.log(rate) - rate - math.lgamma(mode + 1)
    terms = np.exp(logs + at_mode)
    # for large rates the log of the mode's term has few exact places left, the sum has them all
    return low, np.cumsum(terms / terms.sum() if rate > 1000 else terms)


def poisson_tables(rate: Column) -> Column:
    @F.pandas_udf("low long, cdf array<double>")
    def tables(rates: pd.Series) -> pd.DataFrame:
        found = [poisson_table(r) for r in rates]
        return pd.DataFrame({"low": [f[0] for f in found], "cdf": [f[1] for f in found]})

    return tables(rate)


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", alpha: float = 0.5,
        budget: float = 1.0, seed: str = "mix") -> DataFrame:
    """``docs`` exploded to their copies, with copy (1..n) and shuffle_key.

    Input columns named copy or shuffle_key are replaced, others are kept.  Texts of any
    length are only measured and hashed.  Sources are broadcast while their tables stay
    within ``MAX_BROADCAST_BYTES``; beyond that they are joined by a shuffle, in which
    Spark splits the partitions of a hot source at run time.
    """
    rates = source_rates(docs, weights, source_col, text_col, alpha, budget)
    rates = materialise(rates.select(F.col("source").alias("__src"), F.col("rate").alias("__rate"))
                        .withColumn("__p", poisson_tables(F.col("__rate"))))
    size = rates.agg(F.sum(F.octet_length(F.coalesce(F.col("__src").cast("string"), F.lit("")))
                           + 8 * F.size("__p.cdf") + 64)).first()[0] or 0
    if size <= MAX_BROADCAST_BYTES:
        rates = F.broadcast(rates)
    text_md5 = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    copies = F.col("__p.low") + F.size(F.filter("__p.cdf", lambda c: c <= F.col("__u")))
    out = (docs.withColumn("__text", text_md5)
           .withColumn("__u", hash_unit(F.col(id_col), F.col("__text"), seed=seed + ":n"))
           .join(rates, F.col(source_col).eqNullSafe(F.col("__src")))
           .withColumn("__n", copies).where("__n > 0")
           .drop("__u", "__p", "__src", "__rate")
           .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"),
                                                   F.col("__n").cast("long"))))
           .drop("__n"))
    # of the text too: rows without an id are dealt to all partitions
    key = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("__text"),
        F.col("copy").cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    out = out.withColumn("shuffle_key", key).drop("__text")
    return out.repartition(shuffle_partitions(docs.sparkSession), "shuffle_key"
                           ).sortWithinPartitions("shuffle_key", id_col)
