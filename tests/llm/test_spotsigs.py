import hashlib
import re

from tidemark.llm import spotsigs as S
from tidemark.llm.common import load
from tidemark.llm.queries import q_op6_spotsigs
from tidemark.llm.ranges import range_bounds, range_bucket

SF = "/root/testdata/sf0.001"


def chains(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split()
    if not set(words) & set(S.ANCHORS):
        return {" ".join(words[i:i + 1 + S.CHAIN]) for i in range(len(words))}
    out, now = set(), ["^"]
    for w in words + [S.ANCHORS[0]]:
        if w in S.ANCHORS:
            if len(now) > 1:
                out.add(" ".join(now[:1 + S.CHAIN]))
            now = [w]
        else:
            now.append(w)
    return out


def murmur3(text, seed=42):
    """32-bit murmur3 with every byte of the tail mixed as a block of its own."""
    def mix(h, k):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        return (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    raw, h = text.encode(), seed
    whole = len(raw) // 4 * 4
    for i in range(0, whole, 4):
        h = mix(h, int.from_bytes(raw[i:i + 4], "little"))
    for byte in raw[whole:]:
        h = mix(h, (byte - 256 if byte > 127 else byte) & 0xFFFFFFFF)
    h ^= len(raw)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def fingerprint(text):
    return "".join(f"{h & 0xFFFFFFFF:08x}" for h in sorted({murmur3(c) for c in chains(text)}))


def test_query_against_brute_force(spark):
    docs = sorted(((r["doc_id"], r["text"]) for r in load(spark, SF, "documents").collect()),
                  reverse=True)
    got = {r["doc_id"]: r for r in q_op6_spotsigs(spark, SF).collect()}
    assert len(got) == len(docs)
    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (i, t) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][1]
        half = len(t) // 2
        edit = t[:len(t) - half] + nxt[:half]
        r = got[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        assert r["fingerprint"] == fingerprint(t) and r["edited_fingerprint"] == fingerprint(edit)
        assert abs(r["near_edited"] - jac(chains(t), chains(edit))) < 1e-9
        assert abs(r["near_next"] - jac(chains(t), chains(nxt))) < 1e-9


def test_next_wraps_and_crosses_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", 3)
    ids = [5, 5, 7, 100, -3, 0, 2**40, None, None, 11, 12, 13]
    df = spark.createDataFrame([(i, f"t{k:02d}") for k, i in enumerate(ids)],
                               "doc_id long, text string")
    got = [(r["doc_id"], r["text"], r["next_text"]) for r in S.with_next(df).collect()]
    order = sorted(((i, f"t{k:02d}") for k, i in enumerate(ids)),
                   key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = [(*r, order[(k + 1) % len(order)][1]) for k, r in enumerate(order)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_texts_without_common_words_are_spanned(spark):
    words = [f"слово{i} líne{i}" for i in range(40)]
    text, half = " ".join(words), " ".join(words[:20] + [f"other{i} quux{i}" for i in range(20)])
    rows = [(1, text), (2, half), (3, "def f(x):\n    return x+1"), (4, "one"), (5, "!?")]
    got = {r["doc_id"]: r for r in S.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(set(got[i]["sigs"]) == {murmur3(c) for c in chains(t)} for i, t in rows)
    assert len(got[1]["sigs"]) == 80 and got[5]["sigs"] == []
    both = len(set(got[1]["sigs"]) & set(got[2]["sigs"]))
    assert 30 <= both <= 45                       # half the words changed: half the signatures


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.with_next(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {len(r["sigs"]) for r in rows if not r["text"].strip()} == {0}
    assert S.with_next(no_docs).count() == 0
    one = spark.createDataFrame([(1, "only one")], "doc_id long, text string")
    assert S.with_next(one).first()["next_text"] == "only one"


def test_near_duplicates_lose_no_pair(spark):
    docs = load(spark, SF, "documents").select("doc_id", "text")
    sets = {}
    for r in docs.orderBy("doc_id").collect():
        sets.setdefault(frozenset(chains(r["text"])), r["doc_id"])
    items = [(i, s) for s, i in sets.items() if s]
    want = {(min(i, j), max(i, j)) for a, (i, s) in enumerate(items) for j, t in items[a + 1:]
            if len(s & t) >= 0.5 * len(s | t)}
    got = {(r["a"], r["b"]) for r in S.near_duplicates(docs, threshold=0.5).collect()}
    assert got == want


def test_near_duplicates_of_shared_and_null_ids(spark):
    one = " ".join(f"the {w}ing {w}s" for w in "crane harbour signal gauge quay pilot train roof ship".split())
    two = " ".join(f"the {w}er {w}ed" for w in "walk paint climb build farm mine sort plan print".split())
    rows = [(1, one), (1, two), (2, one + " the last word"), (3, two + " the last word"),
            (None, one + " the other end"), (4, None), (5, "")]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.8)
    assert sorted(((r["a"], r["b"]) for r in got.collect()), key=str) == sorted(
        [(1, 2), (1, 3), (1, None), (2, None)], key=str)


def test_range_bucket(spark):
    df = spark.range(1000).selectExpr("id * id as v")
    bounds = range_bounds(df, "v", 10)
    assert bounds[-1] == 999 * 999
    rows = df.withColumn("b", range_bucket(df["v"], bounds)).collect()
    assert all(r["b"] == sum(x < r["v"] for x in bounds) for r in rows)
    assert {r["b"] for r in rows} == set(range(len(bounds)))
