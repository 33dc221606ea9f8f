"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover every training document; the weights are fitted on a
bounded sample (``max_sample`` documents in all, shared equally by the languages,
chosen by a hash of the id and the text) with follow-the-regularised-leader and elastic-net
penalties; a temperature is then fitted on a quarter of the sample that the
weights never saw.  Prediction reads whole texts.

Defined cases: null text or text without a letter -> ``und`` with score 0; no
training row -> every document ``und``; a single language -> that language with
score 1; null language rows and null texts never train; repeated rows are rows of
their own; the id is only hashed (whether a null id trains is the caller's condition).
More than ``max_langs`` languages raise ValueError: the model, which is broadcast, has a
column of weights for each.  Languages of equal probability go to the first by name.
Very long texts are read whole.  Result columns replace input columns of the same name
in ``predict``, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import pack

UNKNOWN = "und"
DIMS = 1 << 14
ORDERS = 3
MAX_SAMPLE = 4096      # documents the weights and the temperature are fitted on
MAX_LANGS = 256        # more training languages are refused, none is dropped
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    idf: np.ndarray        # (DIMS,)
    weights: np.ndarray    # (DIMS + 1, languages); the last row is the bias
    temperature: float


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character 1..3-grams of a whole text, edges marked."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype="<u4").astype(np.uint32)
    counts = np.zeros(DIMS, dtype=np.int64)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    h = np.zeros(len(code), dtype=np.uint32)
    for k in range(ORDERS):
        n = len(code) - k
        if n <= 0:
            break
        h = (h[:n] ^ code[k:k + n]) * _MIX[k]
        h ^= h >> np.uint32(15)
        counts += np.bincount((h * _MIX[0]) >> shift, minlength=DIMS)
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def fit_ftrl(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, dims: int,
             epochs: int = 6, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
             l2: float = 0.02, soft: np.ndarray | None = None) -> np.ndarray:
    """FTRL-proximal over sparse rows (ids, values) -> weights (dims, classes)."""
    z, n = np.zeros((dims, classes)), np.zeros((dims, classes))
    target = np.eye(classes)[y] if soft is None else soft

    def weights(zi, ni):
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        w[np.abs(zi) <= l1] = 0.0
        return w

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            ids, vals = x[i]
            zi, ni = z[ids], n[ids]
            w = weights(zi, ni)
            g = vals[:, None] * (np.exp(_log_softmax(vals @ w)) - target[i])[None, :]
            z[ids] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[ids] = ni + g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature in [0.02, 5] of the lowest held-out log loss."""
    if len(y) == 0:
        return 1.0
    grid = np.geomspace(0.02, 5.0, 60)
    loss = [-_log_softmax(logits / t)[np.arange(len(y)), y].mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            df += gram_counts(text) > 0
            n += 1
    ids = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(ids, -1), pa.int32()), pa.array(np.append(df[ids], n), pa.int64())],
        names=["dim", "df"])


def _sparse(text: str) -> tuple[bytes, bytes]:
    counts = gram_counts(text)
    ids = np.flatnonzero(counts)
    return pack(ids.astype(np.int32)), pack(counts[ids].astype(np.int32))


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_sparse(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array([r[0] for r in rows], pa.binary()),
             pa.array([r[1] for r in rows], pa.binary())], names=["lang", "part", "ids", "counts"])


def train(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", max_sample: int = MAX_SAMPLE, max_langs: int = MAX_LANGS) -> Model:
    """Fit on the rows where ``train_on`` holds, text and language are given."""
    rows = (docs.where(train_on).where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
            .select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                    F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h")))
    size = {r["lang"]: r["count"] for r in rows.groupBy("lang").count()
            .orderBy("lang").limit(max_langs + 1).collect()}
    if len(size) > max_langs:
        raise ValueError(f"more than {max_langs} languages to learn; raise max_langs")
    langs = sorted(size)
    if not langs:
        return Model((), np.zeros(DIMS), np.zeros((DIMS + 1, 0)), 1.0)
    freq = {r["dim"]: r["df"] for r in rows.select("text")
            .mapInArrow(_frequencies, "dim int, df long").groupBy("dim")
            .agg(F.sum("df").alias("df")).collect()}     # at most DIMS + 1 rows
    df = np.array([freq.get(i, 0) for i in range(DIMS)], dtype=np.float64)
    idf = np.log((1.0 + freq[-1]) / (1.0 + df)) + 1.0

    each = max(2, max_sample // len(langs))
    # hashes are uniform, so four times the share wanted holds the lowest ``each`` of them,
    # and the window gets about 4 * each rows of a language however many it has
    near = F.lit(False)
    for lang, n in size.items():                         # at most max_langs literals
        top = (1 << 63) - 1 if n <= 4 * each else -(1 << 63) + 4 * each * (1 << 64) // n
        near = near | ((F.col("lang") == lang) & (F.col("h") <= F.lit(top)))
    known = rows.where(near)
    order = Window.partitionBy("lang").orderBy("h")
    last = (known.select("lang", "h").withColumn("rn", F.row_number().over(order))
            .where(F.col("rn") <= each).groupBy("lang").agg(F.max("h").alias("last")).collect())
    upto = F.lit(False)
    for r in last:                                       # at most max_langs literals
        upto = upto | ((F.col("lang") == r["lang"]) & (F.col("h") <= r["last"]))
    got = (known.where(upto).withColumn("t", F.xxhash64("text"))
           .orderBy("h", "t").limit(2 * max_sample)      # ids that repeat share a hash
           .select("text", "lang", F.pmod(F.xxhash64("h", "t"), F.lit(4)).alias("part"))
           .mapInArrow(_sample_rows, "lang string, part long, ids binary, counts binary")
           .toPandas())
    x, y, part = [], got["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy(), got["part"]
    for ids, counts in zip(got["ids"], got["counts"], strict=True):
        i = np.frombuffer(ids, dtype=np.int32)
        v = np.log1p(np.frombuffer(counts, dtype=np.int32)) * idf[i]
        x.append((np.append(i, DIMS), np.append(v / np.sqrt(v @ v), 1.0)))
    fit, hold = np.flatnonzero(part != 0), np.flatnonzero(part == 0)
    fit = fit if len(fit) else hold
    w = fit_ftrl([x[i] for i in fit], y[fit], len(langs), DIMS + 1)
    logits = np.array([v @ w[i] for i, v in (x[k] for k in hold)]).reshape(len(hold), len(langs))
    return Model(tuple(langs), idf, w, fit_temperature(logits, y[hold]))


def classify(text: str | None, model: Model) -> tuple[str, float]:
    if not has_letter(text) or not model.langs:
        return UNKNOWN, 0.0
    x = vector(gram_counts(text), model.idf)
    at = np.flatnonzero(x)
    z = x[at] @ model.weights[at] + model.weights[-1]
    p = np.exp(_log_softmax(z / model.temperature))
    best = int(np.argmax(p))
    return model.langs[best], float(min(1.0, p[best]))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the calibrated probability)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x max_langs numbers at most

    @F.pandas_udf("lang_pred string, score double")
    def judge(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([classify(t, shared.value) for t in text.tolist()],
                            columns=["lang_pred", "score"])

    return (docs.withColumn("__lang", judge(F.col(text_col)))
            .withColumn("lang_pred", F.col("__lang.lang_pred"))
            .withColumn("score", F.col("__lang.score")).drop("__lang"))
