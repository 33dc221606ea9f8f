"""The trained operators against plain Python on small tables: loops and dictionaries."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import langid, toxicity

MASK = 0xFFFFFFFF


def plain_ftrl(rows, targets, classes, epochs=6, alpha=0.5, beta=1.0, l1=0.02, l2=0.02):
    """Follow the regularised leader, one weight at a time."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i, c):
        if abs(z[i, c]) <= l1:
            return 0.0
        return -(z[i, c] - math.copysign(l1, z[i, c])) / ((beta + math.sqrt(n[i, c])) / alpha + l2)

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            w = {(i, c): weight(i, c) for i in rows[k] for c in range(classes)}
            score = [sum(v * w[i, c] for i, v in rows[k].items()) for c in range(classes)]
            top = max(score)
            total = sum(math.exp(s - top) for s in score)
            for c in range(classes):
                error = math.exp(score[c] - top) / total - targets[k][c]
                for i, v in rows[k].items():
                    g = v * error
                    z[i, c] += g - (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / alpha * w[i, c]
                    n[i, c] += g * g
    return weight


def grams(text):
    """Dimensions of the 1- to 3-grams of a text with a blank at both ends."""
    code, counts = [ord(c) for c in f" {text.lower()} "], Counter()
    for at in range(len(code)):
        h = 0
        for k, mix in enumerate((0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)):
            if at + k < len(code):
                h = (h ^ code[at + k]) * mix & MASK
                h ^= h >> 15
                counts[(h * 0x9E3779B1 & MASK) >> 18] += 1
    return counts


def spark_hash(*values):
    """xxhash64 of columns: every one seeds the next."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else (v % (1 << 64)).to_bytes(8, "little")
        h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def corpus():
    rng = random.Random(2)
    words = {"en": "the harbour crane lifts a crate and then waits", "de": "der hafen und das große schiff wartet",
             "fr": "le port et la grue qui lève une caisse"}
    rows = [(i, " ".join(rng.choices(words[k].split(), k=rng.randint(3, 9))), k)
            for i, k in enumerate(rng.choice("en de fr".split()) for _ in range(70))]
    return rows + [(100, None, "en"), (101, "no language", None), (102, "12 !!", None), (103, "", "de")]


def test_language_model_and_predictions_are_the_plain_ones(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, F.col("doc_id") % 5 != 0)
    used = [r for r in rows if r[0] % 5 and r[1] is not None and r[2] is not None]
    df = Counter(d for _, t, _ in used for d in grams(t))
    idf = lambda d: math.log((1 + len(used)) / (1 + df[d])) + 1
    langs = sorted({r[2] for r in used})
    assert model.langs == tuple(langs)

    def vector(text):
        v = {d: math.log1p(c) * idf(d) for d, c in grams(text).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {**{d: x / size for d, x in v.items()}, langid.DIMS: 1.0}

    sample = sorted((spark_hash(str(i), t), spark_hash(t), t, k) for i, t, k in used)
    part = [spark_hash(h, t) % 4 for h, t, _, _ in sample]
    fit = [(vector(t), [float(k == x) for x in langs]) for (_, _, t, k), p in zip(sample, part, strict=True) if p]
    weight = plain_ftrl([v for v, _ in fit], [y for _, y in fit], len(langs))
    seen = {d for v, _ in fit for d in v}
    for d in seen:
        assert np.allclose(model.weights[d], [weight(d, c) for c in range(len(langs))], atol=1e-9)
    assert not np.delete(model.weights, sorted(seen), axis=0).any()

    def share(text, temperature):
        score = [sum(x * weight(d, c) for d, x in vector(text).items() if d in seen) / temperature
                 for c in range(len(langs))]
        total = sum(math.exp(s - max(score)) for s in score)
        return [math.exp(s - max(score)) / total for s in score]

    held = [(t, langs.index(k)) for (_, _, t, k), p in zip(sample, part, strict=True) if not p]
    loss = {t: -sum(math.log(max(share(x, t)[y], 1e-300)) for x, y in held) / len(held)
            for t in [0.02 * 250 ** (i / 59) for i in range(60)]}
    best = min(loss.values())
    assert min(abs(loss[t] - best) for t in loss if math.isclose(t, model.temperature, rel_tol=1e-9)) < 1e-9
    for r in langid.predict(docs, model).collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        p = share(r["text"], model.temperature)
        assert r["lang_pred"] == langs[p.index(max(p))] and abs(r["score"] - max(p)) < 1e-9


def test_label_model_against_loops():
    rng = random.Random(9)
    truth = [rng.random() < .3 for _ in range(120)]
    v = [[rng.random() < (.8 if y else .1), rng.random() < (.6 if y else .2)] for y in truth]
    v = np.array([[a, a, b, rng.random() < .5] for a, b in v])             # two voters repeat each other
    gold = np.array([int(y) if rng.random() < .4 else -1 for y in truth])
    known = [g for g in gold if g >= 0]
    post = [min(max(float(g), .02), .98) if g >= 0 else sum(known) / len(known) for g in gold]
    discount = [1.0] * 4
    for _ in range(2):
        for _ in range(30):
            mass = [sum(1 - p for p in post), sum(post)]
            rate = [[(sum(w for w, x in zip(ws, v[:, j], strict=True) if x) + .5) / (m + 1) for j in range(4)]
                    for ws, m in (([1 - p for p in post], mass[0]), (post, mass[1]))]
            prior = min(max(sum(post) / len(post), 1e-3), 1 - 1e-3)
            odds = []
            for x, g in zip(v, gold, strict=True):
                o = math.log(prior / (1 - prior)) + {1: math.log(99), 0: -math.log(99), -1: 0.0}[int(g)]
                for j in range(4):
                    a, b = (rate[1][j], rate[0][j]) if x[j] else (1 - rate[1][j], 1 - rate[0][j])
                    o += discount[j] * math.log(a / b)
                odds.append(o)
            post = [1 / (1 + math.exp(-min(max(o, -30), 30))) for o in odds]
        rest = [[float(x[j]) - p * rate[1][j] - (1 - p) * rate[0][j] for j in range(4)]
                for x, p in zip(v, post, strict=True)]
        scale = [math.sqrt(sum(r[j] ** 2 for r in rest) / len(rest)) + 1e-9 for j in range(4)]
        corr = [[sum(r[i] * r[j] for r in rest) / len(rest) / scale[i] / scale[j] for j in range(4)] for i in range(4)]
        discount = [1 / (1 + sum(min(max(corr[i][j], 0), 1) for j in range(4) if j != i)) for i in range(4)]
    got, weight = toxicity.label_model(v, gold)
    assert np.allclose(got, post, atol=1e-9) and np.allclose(weight, discount, atol=1e-9)
    assert max(weight[:2]) < .6 < min(weight[2:])                            # the repeated voter counts about once


def test_linear_classifier_is_the_plain_one():
    rng = random.Random(4)
    rows = [{**{rng.randrange(40): rng.random() + .1 for _ in range(5)}, 40: 1.0} for _ in range(50)]
    post = [rng.random() for _ in rows]
    sparse = [(np.array(sorted(r)), np.array([r[i] for i in sorted(r)])) for r in rows]
    got = langid.fit_ftrl(sparse, np.zeros(50, dtype=int), 2, 41, epochs=6, alpha=0.3, l1=1.0, l2=0.01,
                          soft=np.array([[1 - p, p] for p in post]))
    weight = plain_ftrl(rows, [[1 - p, p] for p in post], 2, alpha=0.3, l1=1.0, l2=0.01)
    assert np.allclose(got, [[weight(i, c) for c in range(2)] for i in range(41)], atol=1e-9)
    assert (got == 0).any() and (got != 0).any()                             # sparse, not empty
