"""Periodic runs of words: suffix automaton with link-cut access.

A run is a stretch of words with smallest period q that cannot be made longer.  Words
are appended one by one to a suffix automaton.  Every state carries the place where
its strings ended last; appending word i gives that place i to all states on the path
from the new state to the root.  Link-cut access keeps paths of one colour together in
splay trees, so a path changes segment by segment, an amortised logarithm of them a
word.  On a segment that ended last at j and covers the suffix lengths (lo, hi], the
distance p = i - j with lo < p <= hi is the root length of a primitive square that ends
at i: the suffix of length p ended at i - p too, and not in between.  Squares of one
length that end at neighbouring words belong to one run.

A sieve comes first.  In a run of length >= max(m, e*q) every window of k words (k as
in ``window_words``) lies q words from an equal one, so a run lies within a stretch of
windows that recur in their text.  Only such stretches are appended to an automaton;
hash collisions make stretches longer and change nothing else.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(end, root length) of every primitively rooted square, by ascending end."""
    # suffix automaton: state 1 is the root, 0 stands for none
    after: list[dict[int, int]] = [{}, {}]
    link, size = [0, 0], [-1, 0]
    # splay trees of the preferred paths, ordered by depth; a tree's root has its colour,
    # and as its parent the state above the path
    left, right, above, seen = [0, 0], [0, 0], [0, 0], [-1, -1]

    def new_state(length: int, edges: dict[int, int], to: int) -> int:
        for column, value in ((after, edges), (link, to), (size, length), (left, 0),
                              (right, 0), (above, 0), (seen, -1)):
            column.append(value)
        return len(link) - 1

    def rotate(x: int) -> None:
        y = above[x]
        z = above[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            above[b] = y
        above[y], above[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def splay(x: int) -> None:
        """x becomes the root of its tree and takes over the colour."""
        root = x
        while (y := above[root]) and (left[y] == root or right[y] == root):
            root = y
        if root == x:
            return
        seen[x] = seen[root]
        while (y := above[x]) and (left[y] == x or right[y] == x):
            z = above[y]
            if z and (left[z] == y or right[z] == y):
                rotate(y if (left[z] == y) == (left[y] == x) else x)
            rotate(x)

    last = 1
    for i, word in enumerate(words):
        state, p = new_state(i + 1, {}, 1), last
        while p and word not in after[p]:
            after[p][word] = state
            p = link[p]
        if p:
            q = after[p][word]
            if size[p] + 1 == size[q]:
                link[state] = q
            else:
                clone = new_state(size[p] + 1, after[q].copy(), link[q])
                while p and after[p].get(word) == q:
                    after[p][word] = clone
                    p = link[p]
                link[q] = link[state] = clone
                splay(q)                       # the clone goes right above q, in q's colour
                if left[q]:
                    left[clone], above[left[q]] = left[q], clone
                left[q], above[clone] = clone, q
        above[state] = link[state]
        last = u = state
        below = hi = found = 0
        while u:                               # link-cut access
            splay(u)
            if found and size[u] < found <= hi:
                yield i, found
            cut, found = right[u], 0
            if cut:
                seen[cut] = seen[u]
            if seen[u] >= 0:
                found, hi = i - seen[u], size[u]
            right[u], below, u = below, u, above[u]
        if found and found <= hi:
            yield i, found
        splay(state)
        seen[state] = i


def runs(words: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of length >= max(min_length, min_exponent * period)."""
    begun: dict[int, tuple[int, int]] = {}          # by period: first and last end of its squares
    out = []

    def close(period: int) -> None:
        first, end = begun[period]
        start = first - 2 * period + 1
        if end + 1 - start >= max(min_length, min_exponent * period):
            out.append((start, end + 1 - start, period))

    for end, period in squares(words):
        if period in begun and begun[period][1] == end - 1:
            begun[period] = (begun[period][0], end)
        else:
            if period in begun:
                close(period)
            begun[period] = (end, end)
    for period in begun:
        close(period)
    return sorted(out, key=lambda r: (r[0], r[2]))


def window_words(min_length: int, min_exponent: int) -> int:
    """The longest window that lies q words from an equal one wherever it is in a run."""
    return min(max(min_length, min_exponent * q) - 2 * q + 1 for q in range(1, min_length + 1))


def stretches(ids: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """[from, to) of the words under maximal rows of windows that recur in their text.

    ``ids`` holds the words of all texts end to end, ``ends`` where each text ends.
    """
    if len(ids) < k:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    n = len(ids) - k + 1
    h = text[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(k):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[j:n + j].astype(np.uint64)
    marked = (text[:n] == text[k - 1:]) & pd.Series(h).duplicated(keep=False).to_numpy()
    step = np.diff(np.concatenate([[0], (marked * (text[:n] + 1)), [0]]))
    edge = np.flatnonzero(step)
    kind = np.concatenate([marked, [False]])[edge]          # a row begins here
    over = np.concatenate([[False], marked])[edge]          # a row ended just before
    return edge[kind], edge[over] + k - 1


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text.

    ``runs`` holds (start, length, period) by start, then period, in words (stretches
    without blanks, tabs and line ends) numbered from 0.  ``collapsed`` joins, by one
    space, the words that no run contains after its first period.  ``min_exponent`` is
    2 at least.

    Null and empty texts have no words, no runs and an empty ``collapsed``.  A very long
    text is one row and is read in one pass; its automaton grows with the stretches that
    recur in it.  Rows are independent: repeated rows and ids give repeated results, null
    ids stay null, other columns, whatever their names, are not looked at, and an empty
    table gives an empty table.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period twice at least")
    k = window_words(min_length, min_exponent)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(_batch, slices(batch, 1))

    def _batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        ids = np.fromiter((number[w] for t in texts for w in t), np.int64)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for a, b in zip(*stretches(ids, ends, k), strict=True):
            doc = int(np.searchsorted(ends, a, side="right"))
            shift = int(a) - (int(ends[doc - 1]) if doc else 0)
            found[doc] += [(s + shift, n, p) for s, n, p in
                           runs(ids[a:b].tolist(), min_length, min_exponent)]
        flat = np.array([r for one in found for r in one], dtype=np.int64).reshape(-1, 3)
        rows = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)],
                                          names=["start", "length", "period"])
        offsets = np.concatenate([[0], np.cumsum([len(one) for one in found])])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
             pa.array([_collapse(t, r) for t, r in zip(texts, found, strict=True)], pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words bigint, runs {RUNS}, collapsed string")


def _collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> str:
    if found:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in found:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words).decode()
