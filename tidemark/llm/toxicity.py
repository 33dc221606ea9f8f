"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons, lexicons mined from labelled sample rows
(words and word beginnings, dealt by rank to several voters) and patterns.  A
generative label model (two classes, one firing rate per voter and class) is fitted by
expectation maximisation over a bounded sample of labelled and unlabelled rows; the
residual correlations of voters under its posterior discount voters that repeat each
other, and the model is fitted again.  A gold label, where a sampled row has one, is one
more voter.  A linear classifier over hashed words, word beginnings and votes is then
trained on the posterior labels and scores every whole text.

The sample is the documented bound of the fit: ``max_positive`` and ``max_negative``
labelled rows and ``max_unlabelled`` others, chosen by a hash of the id.

Defined cases: null text is empty text; an empty text gets the score of the bias
alone; without any labelled row every score is 0.0; a null or other label counts as
unlabelled; documents labelled twice train once per label row; repeated rows get equal
scores; very long texts are read whole; a score of exactly 0.5 predicts 1; an empty table
gives an empty result.  Columns named score or predicted are replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytescan import WORD, chunks, joined, span_hashes, spans
from tidemark.llm.common import pack
from tidemark.llm.langid import fit_ftrl

DIMS = 1 << 18
PREFIXES = (3, 4, 5, 6)         # word beginnings, in bytes
MINED_VOTERS, MINED_WORDS = 8, 64
MAX_POSITIVE, MAX_NEGATIVE, MAX_UNLABELLED = 1500, 2500, 1000

LEXICONS = (
    "idiot idiots stupid moron morons dumb fool foolish imbecile dumm blöd imbécile estúpido tonto",
    "worthless loser losers pathetic useless failure wertlos versager minable inútil perdedor",
    "trash scum garbage filth disgusting vermin abschaum müll ordure basura asqueroso",
    "clown clowns joke freak creep weirdo",
    "kill die hurt beat shoot destroy töten tuer matar",
    "hate hates hated hass haine odio",
)
PATTERNS = 4


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    buf, at = joined(raw)
    return span_hashes(buf, at, at + np.array([len(w) for w in raw], dtype=np.int64))


def _dims(h: np.ndarray, order: int) -> np.ndarray:
    h = (h ^ np.uint64(order * 0x9E3779B9)) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int64)


_LEXICON_DIMS = tuple(np.unique(_dims(_hashes(x.split()), 0)) for x in LEXICONS)


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: the sorted distinct dims of its words and word beginnings, its patterns."""
    for at, run in chunks([(t or "").lower() for t in texts]):
        buf, first = joined(run)
        start, end = spans(WORD[buf])
        every = [_dims(span_hashes(buf, start, end), 0)]
        for k in PREFIXES:
            every.append(_dims(span_hashes(buf, start, np.minimum(start + k, end)), k))
        dims = np.stack(every)
        bound = np.searchsorted(start, np.append(first, len(buf)))
        for t in range(len(run)):
            raw = np.frombuffer((texts[at + t] or "").encode("utf-8"), dtype=np.uint8)
            upper = int(((raw >= 65) & (raw <= 90)).sum())
            lower = int(((raw >= 97) & (raw <= 122)).sum())
            words = int(bound[t + 1] - bound[t])
            marks = int((raw == 33).sum())
            noise = int(np.isin(raw, np.frombuffer(b"#$%&*@", np.uint8)).sum())
            pattern = np.array([upper > lower, marks > 0.1 * words, noise > 0.3 * words, words < 3])
            yield np.unique(dims[:, bound[t]:bound[t + 1]]), pattern


@dataclass(frozen=True)
class Model:
    mined: tuple[np.ndarray, ...]
    weights: np.ndarray           # DIMS + voters + bias

    def votes(self, dims: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        return votes(dims, pattern, self.mined)


def votes(dims: np.ndarray, pattern: np.ndarray, mined: tuple[np.ndarray, ...]) -> np.ndarray:
    lexical = [bool(np.isin(x, dims, assume_unique=True).any()) for x in (*_LEXICON_DIMS, *mined)]
    return np.concatenate([np.array(lexical, dtype=bool), pattern])


def mine(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, ...]:
    """The dims of the highest smoothed log-odds, dealt to the mined voters by rank."""
    count = [np.zeros(DIMS) for _ in range(2)]
    for dims, label in zip(rows, y, strict=True):
        count[label][dims] += 1
    n = [max(1, int((y == k).sum())) for k in range(2)]
    odds = np.log((count[1] + 0.5) / (n[1] + 1)) - np.log((count[0] + 0.5) / (n[0] + 1))
    odds[count[1] < max(3, 0.002 * n[1])] = -np.inf
    best = np.argsort(-odds, kind="stable")[:MINED_VOTERS * MINED_WORDS]
    best = best[odds[best] > np.log(4.0)]
    return tuple(np.sort(best[k::MINED_VOTERS]) for k in range(MINED_VOTERS))


def label_model(v: np.ndarray, gold: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of label 1 and the voters' discounts; gold is 1, 0 or -1 (none)."""
    known = gold >= 0
    x = v.astype(np.float64)
    gold_odds = np.where(gold == 1, np.log(99.0), np.where(gold == 0, -np.log(99.0), 0.0))
    post = np.where(known, np.clip(gold, 0.02, 0.98), gold[known].mean() if known.any() else 0.1)
    discount = np.ones(x.shape[1])
    for _ in range(2):
        for _ in range(rounds):
            rate = [(w @ x + 0.5) / (w.sum() + 1.0) for w in (1 - post, post)]
            prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
            fire = np.log(rate[1] / rate[0]) * discount
            quiet = np.log((1 - rate[1]) / (1 - rate[0])) * discount
            odds = np.log(prior / (1 - prior)) + x @ fire + (1 - x) @ quiet + gold_odds
            post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        rest = x - post[:, None] * rate[1] - (1 - post)[:, None] * rate[0]
        scale = np.sqrt((rest * rest).mean(axis=0)) + 1e-9
        corr = (rest / scale).T @ (rest / scale) / len(x)
        np.fill_diagonal(corr, 0.0)
        discount = 1 / (1 + np.clip(corr, 0, 1).sum(axis=1))
    return post, discount


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims, pattern = [], []
        for d, p in features(batch.column(0).to_pylist()):
            dims.append(pack(d.astype(np.int32)))
            pattern.append(pack(p))
        yield pa.RecordBatch.from_arrays(
            [pa.array(dims, pa.binary()), pa.array(pattern, pa.binary()), batch.column(1)],
            names=["dims", "pattern", "label"])


def train(docs: DataFrame, labels: DataFrame, train_on: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", max_positive: int = MAX_POSITIVE,
          max_negative: int = MAX_NEGATIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """Fit on a bounded sample of the rows where ``train_on`` (of id_col) holds."""
    known = (labels.where(train_on & F.col(label_col).isin(0, 1))
             .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")))
    ids = docs.where(train_on).select(F.col(id_col).alias("id"))
    order = [F.xxhash64(F.col("id").cast("string")), "id"]
    blank = ids.join(known, "id", "left_anti").withColumn("label", F.lit(-1))
    picked = (known.where("label = 1").orderBy(*order).limit(max_positive)
              .unionByName(known.where("label = 0").orderBy(*order).limit(max_negative))
              .unionByName(blank.orderBy(*order).limit(max_unlabelled)))
    most = 2 * (max_positive + max_negative + max_unlabelled)
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    got = (text.join(F.broadcast(picked), "id").orderBy(*order, "label").limit(most)
           .select("text", "label")
           .mapInArrow(_rows, "dims binary, pattern binary, label int").toPandas())
    gold = got["label"].to_numpy()
    if not (gold >= 0).any():
        return None
    rows = [np.frombuffer(d, dtype=np.int32) for d in got["dims"]]
    pats = [np.frombuffer(p, dtype=bool) for p in got["pattern"]]
    seen = np.flatnonzero(gold >= 0)
    mined = mine([rows[i] for i in seen], gold[seen])
    v = np.array([votes(r, p, mined) for r, p in zip(rows, pats, strict=True)])
    post, _ = label_model(v, gold)
    x = [encode(r, votes_of) for r, votes_of in zip(rows, v, strict=True)]
    w = fit_ftrl(x, gold, 2, DIMS + v.shape[1] + 1, epochs=6, alpha=0.3, l1=1.0, l2=0.01,
                 soft=np.stack([1 - post, post], axis=1))
    return Model(mined, (w[:, 1] - w[:, 0]).astype(np.float64))


def encode(dims: np.ndarray, vote: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse classifier row: presence of dims (damped by length), votes, bias."""
    on = DIMS + np.flatnonzero(vote)
    ids = np.concatenate([dims, on, [DIMS + len(vote)]])
    value = np.ones(len(ids))
    value[:len(dims)] = 1.0 / np.sqrt(1.0 + len(dims) / 100.0)
    return ids, value


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (score >= 0.5)."""
    if model is None:
        scored = docs.withColumn("score", F.lit(0.0))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)   # DIMS numbers

        @F.pandas_udf("double")
        def judge(text: pd.Series) -> pd.Series:
            m, out = shared.value, []
            for dims, pattern in features(text.tolist()):
                ids, value = encode(dims, m.votes(dims, pattern))
                out.append(1 / (1 + np.exp(-np.clip(value @ m.weights[ids], -30, 30))))
            return pd.Series(out, dtype="float64")

        scored = docs.withColumn("score", judge(F.col(text_col)))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
