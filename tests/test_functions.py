from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.functions.schema import fingerprint, fingerprint_pairs
from tidemark.functions.text import token_dim, tokenize
from tidemark.functions.timefmt import iso_text, parse_iso


# Fixed values of the index and event formats: dimensions, fingerprints and time texts that
# were recorded elsewhere.  Another value means that stored indexes and logs do not match.

def test_tokenize_drops_short_and_non_ascii(spark):
    df = spark.createDataFrame([("ÉTÉ x a1-b2_c3",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(tokenize("t")).collect()]
    assert got == [["a1", "b2", "c3"], [], []]


def test_token_dims_golden(spark):
    df = spark.createDataFrame([("billing",), ("fraud",), ("aml",)], "t string")
    got = {r[0]: r[1] for r in df.select("t", token_dim("t")).collect()}
    assert got == {"billing": 2028, "fraud": 5613, "aml": 6670}


def test_fingerprints_golden(spark):
    cust = [("customer_id", "bigint"), ("country", "text"), ("email", "text"),
            ("name", "text"), ("updated_at", "timestamptz")]
    assert fingerprint_pairs(cust) == \
        "7677c2381b42b43a182a4807395b43cc70e4b586b8603412dc1c9e2fe440d463"
    schema = spark.createDataFrame(
        [], "case_id long, customer_id long, title string, description string, status string, "
            "updated_at timestamp").schema
    assert fingerprint(schema) == \
        "213f3ba35bd6d58884524de9c22a53f671e63247215ef625249579d09eee7bb3"


def test_iso_text_and_parse(spark):
    df = spark.createDataFrame([("2026-03-18T12:14:47.312228+00:00",),
                                ("2024-01-02T00:00:00+00:00",),
                                ("2024-01-01T00:00:00",), ("not-a-ts",)], "s string")
    out = df.select(iso_text(parse_iso("s")).alias("o")).collect()
    assert [r.o for r in out] == ["2026-03-18T12:14:47.312228+00:00",
                                  "2024-01-02T00:00:00+00:00",
                                  "2024-01-01T00:00:00+00:00", None]


def test_iso_text_other_offset_is_utc(spark):
    df = spark.createDataFrame([("2024-01-01T23:30:00-02:00",)], "s string")
    assert df.select(iso_text(parse_iso("s"))).first()[0] == "2024-01-02T01:30:00+00:00"
    assert datetime(2024, 1, 2, 1, 30, tzinfo=timezone.utc).isoformat() == \
        "2024-01-02T01:30:00+00:00"


def test_lower_dotted_capital_i_splits(spark):
    df = spark.createDataFrame([("İstanbul",)], "t string")
    assert df.select(tokenize("t")).first()[0] == ["stanbul"]
    assert df.select(F.lower("t")).first()[0] == "i̇stanbul"


def test_a_repeated_token_is_hashed_once(monkeypatch):
    from tidemark.functions import text
    seen, sha256 = [], text.hashlib.sha256
    monkeypatch.setattr(text.hashlib, "sha256", lambda t: seen.append(t) or sha256(t))
    got = text._count_terms(["fraud fraud " * 40, None, "a", "x Fraud aml\n"]).to_pylist()
    assert sorted(set(seen)) == [b"aml", b"fraud"] and len(seen) <= 4      # by the separators behind it
    assert got == [[{"dim": 5613, "tf": 80.0}], [], [],
                   [{"dim": 5613, "tf": 1.0}, {"dim": 6670, "tf": 1.0}]]


def test_term_vectors_equal_the_built_ins(spark, monkeypatch):
    from collections import Counter

    from tidemark.functions import text
    texts = ["\u0130x K2 \u212aelvin", "a1-b2_c3 " * 300, "", None, "\u00c9T\u00c9 x", "the\x00and\tOF the", "\ud7ff z9"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    built_in = df.select("i", text.F.transform(text.tokenize("t"), text.token_dim).alias("d"))
    want = {r["i"]: sorted(Counter(r["d"]).items()) for r in built_in.collect()}
    got = {r["i"]: [(e["dim"], int(e["tf"])) for e in r["terms"]]
           for r in text.term_vectors(df, "t", ["i"]).collect()}
    assert got == want
    monkeypatch.setattr(text, "SLICE_BYTES", 4)
    cut = text._terms.func(text.pa.array(texts)).to_pylist()
    assert {i: [(e["dim"], int(e["tf"])) for e in v] for i, v in enumerate(cut)} == want
