"""Exact top-k candidates of many queries over term vectors, cell by cell.

A batch of queries meets nearly every document in some common word, so rows for single
(query, document) pairs grow with the product of both tables.  Here documents and queries are
dealt by the hash of their ids into cells of bounded size; a cogroup brings every block of
queries to every block of documents, multiplies them there and gives back the k best
documents of each query in that cell, at most.  The best of all cells are the best of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import DIM, term_vectors, vector_norm
from tidemark.operators.index import TextIndex

SCORE_SCALE = 1e8                  # 8 places
CELL_DOCS = 2048                   # documents of a cell, about; with more queries as many as these,
MOST_CELL_DOCS = 8192              # up to this
CELL_QUERIES = 65_536              # queries of a cell, about
CELL_DIMS = 2_000_000              # their dimensions, about
COLUMNS = 10_240                   # documents scored at once
COMMON_SHARE, COMMON = 1 / 64, 512 # dimensions multiplied as a matrix: shared by so many pairs, so many at most
CHUNK = 64                         # queries multiplied at once
GROUP = 32                         # documents of which only the best is looked at for a bound


def _flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, row of each value) of a list column."""
    col = pa.concat_arrays(table.column(name).chunks)
    sizes = pc.list_value_length(col).to_numpy(zero_copy_only=False)
    return col.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def _codes(ids: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the id of each row, first row of each id): rows of one id count as one."""
    codes = pa.concat_arrays(ids.chunks).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    return codes, np.unique(codes, return_index=True)[1]


def _best(scores: np.ndarray, k: np.ndarray | int, low: np.ndarray | float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, rounded scores) of the k best above ``low`` in every row of columns in order of their
    ids, and the bounds that later columns must exceed.  Places count on from row to row."""
    scores, k, low = np.atleast_2d(scores), np.atleast_1d(k), np.atleast_1d(low)
    n, width = scores.shape
    groups = width // GROUP
    least = low
    if groups:                         # k groups have a column of such a score or more
        tops = np.sort(scores[:, :groups * GROUP].reshape(n, GROUP, groups).max(axis=1), axis=1)
        kth = np.where(k <= groups, tops[np.arange(n), np.maximum(groups - k, 0)], 0.0)
        least = np.maximum(low, np.floor(kth * SCORE_SCALE + 0.5))
    found = np.flatnonzero(scores > np.maximum((least - 1) / SCORE_SCALE, 0.0)[:, None])
    rounded = np.floor(scores.ravel()[found] * SCORE_SCALE + 0.5)
    over = rounded > low[found // width]
    found, rounded = found[over], rounded[over]
    rows = found // width
    order = np.lexsort((-rounded, rows))                       # stable: the first of equal scores
    ends = np.searchsorted(rows, np.arange(n + 1))
    place = np.arange(len(found)) - ends[rows]
    kept = order[place < k[rows]]
    low = low.astype(np.float64)
    full = ends[1:] - ends[:-1] >= k
    low[full] = rounded[order[(ends[:-1] + k - 1)[full]]]
    kept.sort()
    return found[kept], rounded[kept], low


def _by_row(rows: np.ndarray, n: int, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """(ends of each row's entries beginning with 0, columns in order of their rows)."""
    order = np.argsort(rows, kind="stable")
    return np.append(0, np.cumsum(np.bincount(rows, minlength=n))), *(c[order] for c in columns)


def _scored(asked: tuple[np.ndarray, np.ndarray, np.ndarray], docs: tuple[np.ndarray, np.ndarray, np.ndarray],
            n: int, n_dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, their scores of ``n`` documents) of ``CHUNK`` queries after another.

    ``asked`` is (ends, dims, weights) of the queries, ``docs`` (columns, dims, weights) of the
    documents.  Dimensions that many pairs share are multiplied as a matrix; of the others, only
    the documents that hold them are added up.
    """
    ends, dims, weights = asked
    columns, d_dims, d_ws = docs
    n_queries = len(ends) - 1
    shared = np.bincount(dims, minlength=n_dims) * np.bincount(d_dims, minlength=n_dims)
    common = np.argsort(-shared, kind="stable")[:COMMON]
    common = common[shared[common] > COMMON_SHARE * n_queries * n]
    place = np.full(n_dims, -1, np.int16)
    place[common] = np.arange(len(common))
    own = place[d_dims]
    dense = np.zeros((len(common), n))
    np.add.at(dense, (own[own >= 0], columns[own >= 0]), d_ws[own >= 0])
    starts, at, ws = _by_row(d_dims[own < 0], n_dims, columns[own < 0], d_ws[own < 0])
    rows = np.repeat(np.arange(n_queries), np.diff(ends))
    few = (place[dims] < 0) & (starts[dims + 1] > starts[dims])
    few_ends = np.searchsorted(rows[few], np.arange(n_queries + 1)).tolist()
    firsts, lasts, few_ws = starts[dims[few]], starts[dims[few] + 1], weights[few]
    sizes = lasts - firsts
    for first in range(0, n_queries, CHUNK):
        last = min(first + CHUNK, n_queries)
        some = slice(ends[first], ends[last])
        of, q = place[dims[some]], rows[some] - first
        matrix = np.zeros((last - first, len(common)))
        np.add.at(matrix, (q[of >= 0], of[of >= 0]), weights[some][of >= 0])
        scores = matrix @ dense
        for row, a, b in zip(scores, few_ends[first:last], few_ends[first + 1:last + 1], strict=True):
            if b > a:
                spans = [slice(x, y) for x, y in zip(firsts[a:b].tolist(), lasts[a:b].tolist(), strict=True)]
                added = np.concatenate([ws[s] for s in spans])
                added *= np.repeat(few_ws[a:b], sizes[a:b])
                row += np.bincount(np.concatenate([at[s] for s in spans]), added, n)
        yield first, scores


def _cell(id_col: str, idf: np.ndarray):
    """The function of a cell: (queries, documents) -> (id, doc_id, score).

    ``idf`` by dimension weighs the documents' counts here, in arrays."""
    def score(queries: pa.Table, docs: pa.Table) -> pa.Table:
        if not queries.num_rows or not docs.num_rows:
            return pa.table({id_col: queries.column(id_col).slice(0, 0),
                             "doc_id": docs.column("doc_id").slice(0, 0), "score": pa.array([], pa.float64())})
        docs = docs.take(pc.sort_indices(docs.column("doc_id"), null_placement="at_start"))
        doc_of, doc_row = _codes(docs.column("doc_id"))
        query_of, query_row = _codes(queries.column(id_col))
        ks = np.zeros(len(query_row), np.int64)
        np.maximum.at(ks, query_of, queries.column("_k").to_numpy())
        dims, rows = _flat(queries, "dims")
        used, dims = np.unique(dims, return_inverse=True)
        asked = _by_row(query_of[rows], len(query_row), dims, _flat(queries, "ws")[0])
        place = np.full(DIM, -1, np.int16)
        place[used] = np.arange(len(used))
        d_dims, d_rows = _flat(docs, "dims")
        d_ws = _flat(docs, "ws")[0] * idf[d_dims]
        norm = np.sqrt(np.bincount(d_rows, d_ws * d_ws, minlength=docs.num_rows))
        norm[norm == 0] = 1.0
        d_dims, d_ws, columns = place[d_dims], d_ws / norm[d_rows], doc_of[d_rows].astype(np.int64)
        low = np.full(len(ks), -1.0)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for start in range(0, len(doc_row), COLUMNS):
            a, b = np.searchsorted(columns, [start, start + COLUMNS])
            met = np.flatnonzero(d_dims[a:b] >= 0) + a
            n = min(COLUMNS, len(doc_row) - start)
            for q, scores in _scored(asked, (columns[met] - start, d_dims[met], d_ws[met]), n, len(used)):
                some = slice(q, q + len(scores))
                found, scores, low[some] = _best(scores, ks[some], low[some])
                out.append((query_row[some][found // n], doc_row[start + found % n], scores))
        q_rows, d_found, scores = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (
            np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({id_col: queries.column(id_col).take(q_rows), "doc_id": docs.column("doc_id").take(d_found),
                         "score": scores / SCORE_SCALE})
    return score


def best_pairs(index: TextIndex, requests: DataFrame, query_col: str, id_col: str,
               n_queries: int, n_dims: int) -> DataFrame:
    """(id, doc_id, score) of pairs that share a dimension, every query's ``_k`` best among them.

    ``requests`` has ``_k`` beside the query; rows of one id add up, null ids have no results.
    """
    deal = max(1, -(-n_queries // CELL_QUERIES), -(-n_dims // CELL_DIMS))
    # many queries meet larger cells, or their copies for every cell would outgrow the documents
    cell_docs = max(CELL_DOCS, min(n_queries, MOST_CELL_DOCS))
    cells = max(1, -(-(index.n_docs.first()["n"] or 0) // cell_docs))

    def dealt(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    def arrays(df: DataFrame, *keep: str, field: str, by=None) -> DataFrame:
        ws = F.col(f"terms.{field}")
        return df.select(*keep, F.col("terms.dim").alias("dims"),
                         (ws if by is None else F.transform(ws, lambda w: w / F.col(by))).alias("ws"))

    asked = term_vectors(requests.where(F.col(id_col).isNotNull()), query_col, [id_col, "_k"])
    asked = asked.select(id_col, "_k", "terms", vector_norm("terms", "tf").alias("_qn"))
    asked = dealt(arrays(asked, id_col, "_k", field="tf", by="_qn"), id_col, "_q", deal, "_d", cells)
    docs = dealt(arrays(index.terms, "doc_id", field="tf"), "doc_id", "_d", cells, "_q", deal)
    idf = np.zeros(DIM)
    for row in index.idf.collect():                   # DIM rows at most
        idf[row["dim"]] = row["idf"]
    types = {**dict(requests.dtypes), **dict(docs.dtypes)}
    # about one cell a task, whatever number of shuffle partitions is set: a task sorts what it gets
    asked, docs = (df.repartition(cells * deal, "_d", "_q") for df in (asked, docs))
    return asked.groupBy("_d", "_q").cogroup(docs.groupBy("_d", "_q")).applyInArrow(
        _cell(id_col, idf), f"`{id_col}` {types[id_col]}, doc_id {types['doc_id']}, score double")
