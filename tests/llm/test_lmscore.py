import math
import re
from collections import Counter

from tidemark.llm import lmscore
from tidemark.llm.common import load

SF = "/root/testdata/sf0.001"


def brute(rows, order=3, backoff=0.4):
    toks = [re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", (t or "").lower()) for _, t in rows]
    own = [[Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
           for w in toks]
    every = [sum((o[n] for o in own), Counter()) for n in range(order)]
    total, out = sum(map(len, toks)), []
    for (i, _), w, o in zip(rows, toks, own, strict=True):
        rest = total - len(w)
        log = 0.0
        for k in range(len(w)):
            def c(*g, o=o):
                return every[len(g) - 1][g] - o[len(g) - 1][g]
            s = c(w[k]) / max(rest, 1) if c(w[k]) > 0 else backoff / (rest + 1)
            for n in range(2, min(order, k + 1) + 1):
                g = tuple(w[k - n + 1:k + 1])
                s = c(*g) / c(*g[:-1]) if c(*g) > 0 else backoff * s
            log += math.log(s)
        out.append((i, len(w), log, log / len(w) if w else None))
    return out


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = sorted(brute(rows), key=str)
    got = sorted((tuple(r) for r in lmscore.score(df).collect()), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1], round(r[2], 4))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-9)
        assert (g[3] is None) == (w[3] is None)


def test_scores_match_brute_force(spark):
    check(load(spark, SF, "documents"))


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty(no_docs):
    assert lmscore.score(no_docs).count() == 0
