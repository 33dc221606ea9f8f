import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import vector_codes as V
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code string, error string"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Lloyd rounds one number at a time: ([(id, code, error, label error)], books)."""
    kept = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // parts if kept else 0
    books = [[v[p * width:(p + 1) * width] for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(part, s):
        return min((sum((a - b) ** 2 for a, b in zip(s, c, strict=True)), e)
                   for e, c in enumerate(books[part]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _ in kept:
            for p in range(parts):
                s = v[p * width:(p + 1) * width]
                members[p, near(p, s)[1]].append(s)
        for (p, e), got in members.items():
            books[p][e] = [sum(col) // len(got) for col in zip(*got, strict=True)]
    coded, total = [], defaultdict(int)
    for i, v, y in kept:
        best = [near(p, v[p * width:(p + 1) * width]) for p in range(parts)]
        coded.append((i, y, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
        total[y] += coded[-1][3]
    return sorted(((i, c, e, total[y]) for i, y, c, e in coded), key=str), books


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def vectors(n, width=16, seed=1):
    rng = random.Random(seed)
    f = lambda: float(np.float32(rng.choice([rng.gauss(0, 1), 0.25, -0.125, 0.0])))
    return [(i, [f() for _ in range(width)], rng.choice([None, 1, 2])) for i in range(n)]


ODD = [(900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] * 16, 1),
       (903, [float("inf")] + [0.0] * 15, None), (904, [float("-inf")] * 16, 2),
       (None, [0.5] * 16, None), (7, [0.5] * 16, 3), (7, [0.25] * 16, 3), (7, [0.25] * 16, 3)]


@pytest.mark.parametrize("rows", [vectors(150) + ODD, vectors(9), [(5, [1.0] * 16, None)] * 40, ODD[:5]])
def test_against_plain_rounds(spark, rows):
    want, books = plain(rows)
    found, book = V.compress(table(spark, rows))
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found.collect()]
    assert sorted(got, key=str) == want
    assert book.tolist() == books or not want
    assert found.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_many_labels_and_wide_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(V, "BROADCAST_LABELS", 1)
    rows = vectors(60, seed=4)
    found, _ = V.compress(table(spark, rows), entries=5, rounds=2, parts=4)
    got = sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found.collect()), key=str)
    assert got == plain(rows, parts=4, entries=5, rounds=2)[0]


def test_gathers_equal_differences():
    rng = np.random.default_rng(2)
    x, book = rng.integers(-9, 9, (70, 6)), rng.integers(-9, 9, (3, 4, 2))
    pairs = [np.unique(x[:, d], return_inverse=True) for d in range(6)]
    entry, error = V.nearest([v for v, _ in pairs], [c for _, c in pairs], 70, book)
    far = ((x.reshape(70, 3, 1, 2) - book[None]) ** 2).sum(-1)
    assert (entry.T == far.argmin(-1)).all() and (error.T == far.min(-1)).all()


def test_errors(spark):
    with pytest.raises(ValueError):
        V.compress(table(spark, [(1, [1.0] * 12, 1)]))
    with pytest.raises(ValueError):
        V.compress(table(spark, vectors(3)), entries=300)
    with pytest.raises(ValueError):
        V.compress(table(spark, [(1, [1e30] * 16, 1)]))
    with pytest.raises(Exception, match="more than one length"):
        V.compress(table(spark, vectors(30) + [(99, [1.0] * 8, 1)]))[0].collect()


def test_query_against_plain_rounds(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, books = plain(rows)
    got = QUERIES["op13_vector_codes"](spark, sf).collect()
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=str) == want
    assert {r["codebooks_sha256"] for r in got} == {V.books_sha256(np.array(books))}
