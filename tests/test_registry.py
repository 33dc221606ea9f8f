import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

FAST = ["tokens", "term_freq", "search_topk", "search_topk_batch", "search_all_versions",
        "incremental_delta", "high_water_mark", "lake_round_trip", "lake_merge_two_runs",
        "late_row_audit", "latest_version", "watermark_fallback", "stream_versions", "dq_unique", "dq_foreign_key",
        "apply_change_set"]


def _rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)),
                        key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["doc_id", "rank", "score"]
    assert 0 < len(rows) <= 10


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLE)          # the training-data queries test themselves


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMOKE).toPandas()
    dd = duck.execute(E.oracle_sql()[name]).df()
    assert _rows(sp) == _rows(dd)
