import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import word_runs
from tidemark.llm.common import slices
from tidemark.llm.queries import QUERIES

BLANKS = "[^\x20\x09-\x0D]+"


def plain_runs(words, min_length=6, min_exponent=4):
    """Every period tried at every place; a stretch keeps its smallest period."""
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def random_words(rng):
    n = rng.randint(0, 60)
    words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(n)]
    if n and rng.random() < .6:
        a, p = rng.randrange(n), rng.randint(1, 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("rule", [(6, 4), (2, 2), (5, 3), (8, 2), (3, 4)])
def test_runs_and_sieve_against_plain_search(rule):
    rng, k = random.Random(sum(rule)), word_runs.window_words(*rule)
    texts = [random_words(rng) for _ in range(600)]
    want = [plain_runs(t, *rule) for t in texts]
    assert [word_runs.runs(t, *rule) for t in texts] == want and any(want)
    ends = np.cumsum([len(t) for t in texts])
    ids = np.array([w for t in texts for w in t])
    got = [[] for _ in texts]
    for a, b in zip(*word_runs.stretches(ids, ends, k), strict=True):
        doc = int(np.searchsorted(ends, a, side="right"))
        assert b <= ends[doc]                                # never across texts
        got[doc] += [(s + int(a - (ends[doc] - len(texts[doc]))), n, q)
                     for s, n, q in word_runs.runs(ids[a:b].tolist(), *rule)]
    assert [sorted(g) for g in got] == want


def test_primitive_squares_only():
    got = set(word_runs.squares([7] * 9))
    assert got == {(i, 1) for i in range(1, 9)}
    words = [0, 1, 0, 1, 0, 0, 1, 0, 1, 0]
    want = {(i, q) for i in range(10) for q in range(1, 6) if i + 1 >= 2 * q
            and words[i + 1 - 2 * q:i + 1 - q] == words[i + 1 - q:i + 1]
            and not any(q % d == 0 and words[i + 1 - q:i + 1] == words[i + 1 - q:i + 1 - q + d] * (q // d)
                        for d in range(1, q))}
    assert set(word_runs.squares(words)) == want


def test_long_texts_take_one_pass():
    assert word_runs.runs([1] * 60_000, 6, 4) == [(0, 60_000, 1)]
    assert word_runs.runs([i % 5000 for i in range(60_000)], 6, 4) == [(0, 60_000, 5000)]


def echo(doc_id, words):
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = echo(doc_id, re.findall(BLANKS, text or ""))
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_against_plain_search(spark, odd_docs, tmp_path):
    rng = random.Random(8)
    rows = [(100 + i, " \t".join("abc"[w % 3] + "é" * (w // 3) for w in random_words(rng)))
            for i in range(300)] + [(1000, "x " * 3000), (1001, "no\xa0break \x1c \x85 sign " * 9)]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"),
                                allowMissingColumns=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_word_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    want = [expected(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[1] > 1 for w in want) > 5


def test_operator_returns_runs_and_texts(spark, odd_docs, no_docs):
    df = spark.createDataFrame([(1, "go la la la la la la home"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in word_runs.find_runs(df).collect()}
    assert rows[1]["collapsed"] == "go la home" and rows[1]["n_words"] == 8
    assert [tuple(x) for x in rows[1]["runs"]] == [(1, 6, 1)]
    assert rows[2]["runs"] == [] and rows[2]["collapsed"] == ""
    assert word_runs.find_runs(odd_docs).count() == odd_docs.count()
    assert word_runs.find_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        word_runs.find_runs(df, min_exponent=1)


def test_batches_are_cut_by_bytes():
    texts = ["a" * 10, None, "", "é" * 30, "b" * 500, "c", "d" * 60]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["i", "t"])
    parts = list(slices(batch, 1, 70))
    assert [p.num_rows for p in parts] == [4, 1, 2] and pa.Table.from_batches(parts).to_pydict() == {
        "i": list(range(7)), "t": texts}
    assert list(slices(batch.slice(0, 0), 1)) == []
    assert [p.num_rows for p in slices(batch.slice(4), 1, 1)] == [1, 1, 1]
