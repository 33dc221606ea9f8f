import random
import string

import duckdb
import pytest

from tests.test_registry import TABLES
from tests.test_registry import _rows as _row_set
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _rows(pdf):
    """Row set with null longs alike, whichever engine wrote them."""
    plain = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v
    return _row_set(pdf.astype(object).where(pdf.notna(), None).map(plain))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert _rows(QUERIES[name](spark, SF).toPandas()) == _rows(duck.execute(ORACLE[name]).df())


def test_the_statements_have_something_to_find(duck):
    found = {k: duck.execute(ORACLE[k]).df() for k in ("op1_suffix_dedup", "op4_urls", "op8_secrets")}
    assert (found["op1_suffix_dedup"]["n_removed"] > 0).any()
    assert set(found["op4_urls"]["verdict"]) == {"allow", "block"}
    assert found["op4_urls"]["template"].str.contains("*", regex=False).any()
    assert (found["op8_secrets"][["n_assign", "n_hex"]].sum() > 0).all()


def test_added_secret_spans_match_sql(spark, tmp_path):
    """Bare codes of every alphabet and length beside words: found, and as the statement says."""
    rng, letters = random.Random(5), string.ascii_letters
    kinds = {"base62": letters + string.digits, "base64": letters + string.digits + "+/",
             "upper": string.ascii_uppercase + string.digits, "lower": string.ascii_lowercase + string.digits}
    code = lambda a, n: "".join(rng.choices(a, k=n))
    vocabulary = "harbour crane signal gauge repair quay pilot storm lamp the of and tide".split()
    word = lambda: "_".join(rng.choices(vocabulary, k=5))
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(150)]
    texts += [f"é token={code(kinds['base62'], 32)} and {word()} AKIA{code(kinds['upper'], 18)}=x" for _ in range(80)]
    planted = [(k, n) for k in kinds for n in (20, 32, 64) for _ in range(10)]
    texts += [f"bare {code(kinds[k], n)} beside {word()}" for k, n in planted] + ["", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op8_secrets"](spark, str(tmp_path)).toPandas()
    assert _rows(got) == _rows(con.execute(ORACLE["op8_secrets"]).df())
    added = got.sort_values("doc_id")["spans"].str.count("random:").tolist()
    assert added[:150] == [0] * 150 and added[-2:] == [0, 0]
    assert sum(added[230:-2]) >= 0.95 * len(planted) and max(added) == 1
