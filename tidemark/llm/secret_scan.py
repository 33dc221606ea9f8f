"""Secret scans: fixed patterns plus character Markov models, all in DataFrame functions.

Base spans come from three patterns (assignments, access keys, hex runs).  Two
first-order character models, one of random strings and one of ordinary words and
identifiers, are counted over all documents: base values are the labelled random
strings; the words are all runs of token characters outside base spans, long ones if
they hold letters or marks only.  A token's random likelihood is the larger of the
counted one and that of equally likely characters of its classes, so a step that no
base value has does not count against it.  Long tokens whose log-likelihood ratio
passes ``min_ratio``, which grows with the length, add spans of kind ``random``; base
spans always stay.

Defined cases: null text is empty text; no match gives zero counts and empty span
lists; overlapping spans of different kinds are all listed; with no training token
at all both models are uniform and nothing is added; repeated rows get equal
results.  Offsets are code points, ends exclusive.  A column named spans is replaced,
others are kept.  Very long texts are scanned whole, in one row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"            # the same spans as runs of [0-9a-f]+ with 24 or more
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
NOT_TOKEN = "[^A-Za-z0-9+/_=-]+"
WORD = "^(?:.{2,19}|[A-Za-z_]+|[+/_=-]+)$"       # of token characters; long codes train nothing
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
MIN_RATIO = 12.0                 # natural log; a long token is random that much likelier
SHORTEST = 20                    # characters of the shortest token; min_ratio is for these
FLOOR = 0.02                     # share of the uniform model in that of words
SPANS = "array<struct<kind:int,start:int,end:int,match:string>>"


def match_spans(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches with their places, in order."""
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gap = F.zip_with(F.split(text, pattern, -1), match,
                     lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))
    placed = F.aggregate(
        F.filter(gap, lambda g: g["m"].isNotNull()),
        F.struct(F.lit(0).alias("pos"), F.array().cast(SPANS).alias("out")),
        lambda acc, g: F.struct(
            (acc["pos"] + g["gap"] + F.length(g["m"])).alias("pos"),
            F.concat(acc["out"], F.array(F.struct(
                F.lit(kind).alias("kind"), (acc["pos"] + g["gap"]).alias("start"),
                (acc["pos"] + g["gap"] + F.length(g["m"])).alias("end"),
                g["m"].alias("match")))).alias("out")),
        lambda acc: acc["out"])
    return F.when(text.rlike(pattern), placed).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    assign = F.filter(match_spans(text, ASSIGN, 0),
                      lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6)
    access = F.filter(match_spans(text, ACCESS, 1), lambda s: F.length(s["match"]) >= 20)
    return F.concat(assign, access, match_spans(text, HEX, 2))


def _outside(token: Column, base: Column) -> Column:
    return ~F.exists(base, lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"]))


def _steps(token: Column) -> Column:
    """Places of a token's neighbouring characters in the table of steps."""
    k = len(ALPHABET)

    def locate(i):
        a = F.call_function("locate", F.substr(token, i, F.lit(1)), F.lit(ALPHABET))
        b = F.call_function("locate", F.substr(token, i + 1, F.lit(1)), F.lit(ALPHABET))
        return F.when((a > 0) & (b > 0), (a - 1) * k + b).otherwise(F.lit(0))

    return F.when(F.length(token) > 1,
                  F.transform(F.sequence(F.lit(1), F.length(token) - 1), locate)
                  ).otherwise(F.array().cast("array<int>"))


def train_words(docs: DataFrame, text_col: str = "text") -> tuple[list[float], list[float]]:
    """(log-likelihood ratio, minus the log-likelihood as a word) of every character step.

    Words are counted first and their steps after that, over all documents; at most
    2 * len(ALPHABET)**2 counts reach the driver.  A step's share among words leans
    towards that of its second character, and every step has at least ``FLOOR`` of the
    uniform share, so one unseen step alone says little."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    seen = docs.select(text.alias("t")).withColumn("base", base_spans(F.col("t")))
    value = F.transform("base", lambda b: F.struct(
        F.lit(1).alias("y"), F.when(b["kind"] == 0, F.regexp_extract(b["match"], ASSIGN, 2))
        .otherwise(b["match"]).alias("v")))
    word = F.transform(F.split(redact(F.col("t"), _by_start(F.col("base")), " "), NOT_TOKEN),
                       lambda w: F.struct(F.lit(0).alias("y"), w.alias("v")))
    words = (seen.select(F.explode(F.concat(value, word)).alias("x")).select("x.y", "x.v")
             .groupBy("y", "v").agg(F.count(F.lit(1)).alias("n"))
             .where((F.col("y") == 1) | F.col("v").rlike(WORD)))
    steps = words.select("y", "n", F.explode(_steps(F.col("v"))).alias("step")).where("step > 0")
    count = {(r["y"], r["step"]): r["n"] for r in
             steps.groupBy("y", "step").agg(F.sum("n").alias("n")).collect()}
    k, ratio, surprise = len(ALPHABET), [], []
    grid = [[[count.get((y, a * k + b + 1), 0) for b in range(k)] for a in range(k)] for y in (0, 1)]
    second = [sum(row[b] for row in grid[0]) + 0.5 for b in range(k)]
    for a in range(k):
        total = [sum(grid[y][a]) for y in (0, 1)]
        for b in range(k):
            q = (grid[0][a][b] + 0.5 * k * second[b] / sum(second)) / (total[0] + 0.5 * k)
            q = (1 - FLOOR) * q + FLOOR / k
            p = (grid[1][a][b] + 0.5) / (total[1] + 0.5 * k)
            ratio.append(round(math.log(p / q), 3))
            surprise.append(round(-math.log(q), 3))
    return ratio, surprise


def _sum_of(steps: Column, model: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    return F.aggregate(steps, F.lit(0.0),
                       lambda acc, i: acc + F.when(i > 0, F.element_at(table, i)).otherwise(0.0))


def word_ratio(token: Column, model: tuple[list[float], list[float]]) -> Column:
    """The larger of the counted random model's ratio and that of the token's classes."""
    ratio, surprise = model
    size = sum((F.when(token.rlike(c), F.lit(n)).otherwise(F.lit(0)) for c, n in (
        ("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), ("[+/_=-]", 5))), F.lit(0))
    return F.greatest(_sum_of(_steps(token), ratio), _sum_of(_steps(token), surprise)
                      - (F.length(token) - 1) * F.log(size.cast("double")))


def is_random(token: Column, model: tuple[list[float], list[float]],
              min_ratio: float = MIN_RATIO) -> Column:
    """``min_ratio`` holds for the shortest token and grows with the number of steps."""
    return F.round(word_ratio(token, model), 6) >= F.greatest(
        F.lit(1.0), (F.length(token) - 1) / F.lit(SHORTEST - 1.0)) * F.lit(min_ratio)


def scan(docs: DataFrame, text_col: str = "text", model=None,
         min_ratio: float = MIN_RATIO) -> DataFrame:
    """``docs`` with spans: array of (kind, start, end, match), by start then kind."""
    if model is None:
        model = train_words(docs, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    token = F.filter(match_spans(text, TOKEN, 3), lambda s: _outside(s, F.col("__base"))
                     & is_random(s["match"], model, min_ratio))
    return (docs.withColumn("__base", base_spans(text))
            .withColumn("spans", F.concat("__base", token)).drop("__base")
            .withColumn("spans", F.transform(
                _by_start(F.col("spans")),
                lambda s: F.struct(kind_name(s["kind"]).alias("kind"), s["start"].alias("start"),
                                   s["end"].alias("end"), s["match"].alias("match")))))


def _by_start(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        s["match"].alias("match"))))


def kind_name(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every maximal run of overlapping spans replaced by ``mark``."""
    cut = F.aggregate(
        spans, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            (s["start"] >= acc["pos"]) & ((s["start"] > acc["pos"]) | (acc["pos"] == 0)),
            F.struct(s["end"].alias("pos"), F.concat(
                acc["out"], F.substr(text, acc["pos"] + 1, s["start"] - acc["pos"]),
                F.lit(mark)).alias("out"))).otherwise(
            F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def only(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: reduce(lambda a, b: a | b, (s["kind"] == k for k in kinds)))
