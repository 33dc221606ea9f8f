"""Stupid-backoff language-model scores.

The n-gram count tables (orders 1 to ``order``) are partitioned by the hash of the
n-gram.  Groups of documents send their n-grams with counts to the tables and get the
corpus counts of exactly those back (the join); every document is scored with the
counts of all *other* documents, so a text does not vouch for itself.

A token's score starts at the longest order its position allows: c(n-gram) / c(context)
if the n-gram occurs elsewhere, otherwise ``backoff`` times the score one order lower;
the unigram share is c(w) / N, and backoff / (N + 1) for a word seen nowhere else.  A
document's score is the sum of the natural logs.

Tokens: maximal runs of letters and digits of the lower-cased text.  Defined cases:
null, empty or word-less texts have 0 tokens, sum 0.0 and null mean; repeated rows are
documents of their own and count for each other; null ids are allowed; very long texts
are read whole; columns other than the id and the text, whatever their names, are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bytescan import WORD, chunks, joined, mix64, span_hashes, spans, window_hashes
from tidemark.llm.exchange import (ANSWER_ROWS, KEY_BITS, KEY_ROWS, answer_rows, answers,
                                   bucket_keys, grouped, key_rows)

ORDER = 3
BACKOFF = 0.4
_TOTAL = np.uint64((1 << KEY_BITS) - 1)      # the key under which tokens are counted
SCORES = "doc_id long, n_tokens long, log_score double, mean_log_score double"


def _grams(texts: list[str], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Document number of every token; per order the key of the n-gram that ends there
    (0 where the document has too few tokens before it)."""
    doc, grams = [], [[] for _ in range(order)]
    for at, run in chunks([t.lower() for t in texts]):
        buf, first = joined(run)
        start, end = spans(WORD[buf])
        h = span_hashes(buf, start, end)
        d = np.searchsorted(first, start, "right") - 1
        doc.append(d + at)
        for n in range(1, order + 1):
            key = np.zeros(len(h), dtype=np.uint64)
            if len(h) >= n:
                own = mix64(window_hashes(h, n) + np.uint64(n)) >> np.uint64(64 - KEY_BITS)
                own = np.clip(own, np.uint64(1), _TOTAL - np.uint64(1))
                key[n - 1:] = np.where(d[n - 1:] == d[:len(d) - n + 1], own, np.uint64(0))
            grams[n - 1].append(key)
    if not doc:
        return np.empty(0, dtype=np.int64), [np.empty(0, dtype=np.uint64)] * order
    return np.concatenate(doc), [np.concatenate(g) for g in grams]


def _counter(order: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        _, grams = _grams(table.column("text").to_pylist(), order)
        every = np.concatenate(grams)
        keys, n = np.unique(every[every > 0], return_counts=True)
        keys, n = np.append(keys, _TOTAL), np.append(n, len(grams[0]))
        return key_rows(table.column("grp")[0].as_py(), keys, n.astype(np.uint32), buckets)
    return run


def _sum(table: pa.Table) -> pa.Table:
    """One part of the count tables: the corpus count of every key asked for."""
    grp, n, keys, counts = bucket_keys(table, np.uint32)
    known, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64)
    return answer_rows(table.column("bucket")[0].as_py(), grp, n, total[place])


def _scorer(order: int, backoff: float):
    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        ids, texts = docs.column("doc_id"), docs.column("text").to_pylist()
        doc, grams = _grams(texts, order)
        total = answers(counts, np.int64)
        size = np.bincount(doc, minlength=len(texts))
        rest = _elsewhere(grams, doc, total)                        # counts in other documents
        n_rest = (total[-1] if len(total) else 0) - size[doc]
        seen = rest[0] > 0
        score = np.where(seen, rest[0] / np.maximum(n_rest, 1), backoff / (n_rest + 1.0))
        for n in range(2, order + 1):
            context = np.zeros(len(doc), dtype=np.int64)
            context[1:] = rest[n - 2][:-1]
            hit = rest[n - 1] > 0
            lower = np.where(grams[n - 1] > 0, backoff * score, score)
            score = np.where(hit, rest[n - 1] / np.maximum(context, 1), lower)
        log = np.bincount(doc, weights=np.log(score), minlength=len(texts))
        mean = [float(x) / int(m) if m else None for x, m in zip(log, size, strict=True)]
        return pa.table({"doc_id": ids, "n_tokens": pa.array(size, pa.int64()),
                         "log_score": pa.array(log, pa.float64()),
                         "mean_log_score": pa.array(mean, pa.float64())})
    return run


def _elsewhere(grams: list[np.ndarray], doc: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Corpus counts less the token's own document's, by order; 0 without an n-gram.

    One stable sort by key leaves the documents of a key in order too."""
    every, own_doc = np.concatenate(grams), np.tile(doc, len(grams))
    order = np.argsort(every, kind="stable")
    key, own_doc = every[order], own_doc[order]
    if not len(key):
        return np.zeros((len(grams), 0), dtype=np.int64)
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    place = np.cumsum(new_key) - 1
    run = np.cumsum(new_key | np.concatenate([[True], own_doc[1:] != own_doc[:-1]])) - 1
    if key[0] == 0:
        total = np.concatenate([[0], total])
    out = np.empty(len(key), dtype=np.int64)
    out[order] = np.where(key > 0, total[place] - np.bincount(run)[run], 0)
    return out.reshape(len(grams), len(doc))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
          backoff: float = BACKOFF) -> DataFrame:
    """(doc_id, n_tokens, log_score, mean_log_score) of every document."""
    parts, n = grouped(docs, id_col, text_col)
    counts = parts.groupBy("grp").applyInArrow(_counter(order, n), KEY_ROWS)
    table = counts.groupBy("bucket").applyInArrow(_sum, ANSWER_ROWS)
    return parts.groupBy("grp").cogroup(table.groupBy("grp")).applyInArrow(
        _scorer(order, backoff), SCORES)
