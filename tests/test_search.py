import random

import pytest
from pyspark.sql import functions as F

from tests.corpora import SEARCH_CASES, golden
from tidemark.operators.index import RepeatedIds, build_index, current_build, write_index
from tidemark.operators.search import (bounded_pairs, query_rows, search, search_one,
                                       validate_requests)

QUERY = "harbour storm"
GOLDEN = golden(SEARCH_CASES, QUERY, 10)


def _index(df):
    return build_index(df, "case_id", ["title", "description"], ["title", "status"])


def _pairs(rows):
    return [(r.case_id, r.score) for r in rows]


def test_golden_scores(spark, search_cases):
    rows = search_one(spark, _index(search_cases), QUERY, 10).collect()
    assert _pairs(rows) == GOLDEN
    assert [r.rank for r in rows] == list(range(1, len(GOLDEN) + 1))
    assert rows[0].title == "Harbour storm drill" and rows[0].status == "open"


def test_top_k_cuts(spark, search_cases):
    rows = search_one(spark, _index(search_cases), QUERY, 3).collect()
    assert _pairs(rows) == GOLDEN[:3]


def test_unknown_words_and_short_tokens_return_nothing(spark, search_cases):
    idx = _index(search_cases)
    assert search_one(spark, idx, "xyzzy frobnicator", 5).count() == 0
    assert search_one(spark, idx, "a !", 5).count() == 0


def test_rejects_blank_and_bad_top_k(spark, search_cases):
    idx = _index(search_cases)
    with pytest.raises(ValueError):
        search_one(spark, idx, "   ", 5)
    for k in (0, 101):
        with pytest.raises(ValueError):
            search_one(spark, idx, "harbour", k)


def test_empty_index_returns_nothing(spark, search_cases):
    idx = _index(search_cases.limit(0))
    assert search_one(spark, idx, QUERY, 5).count() == 0


def test_deterministic_across_partitionings(spark, search_cases):
    results = []
    for parts in ("1", "8", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        for _ in range(2):
            results.append(_pairs(search_one(spark, _index(search_cases), QUERY,
                                             10).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert all(r == results[0] for r in results)
    scores = [s for _, s in results[0]]
    assert scores == sorted(scores, reverse=True)


def test_batch_search_matches_single(spark, search_cases):
    idx = _index(search_cases)
    q = spark.createDataFrame([(1, QUERY, 10), (2, "repair crew", 2),
                               (3, "", 5), (4, "tide", 101)],
                              "query_id long, query string, top_k int")
    got = search(idx, q).orderBy("query_id", "rank").collect()
    assert [(r.case_id, r.score) for r in got if r.query_id == 1] == GOLDEN
    q2 = [(r.case_id, r.score) for r in got if r.query_id == 2]
    assert q2 == _pairs(search_one(spark, idx, "repair crew", 2).collect())
    assert not [r for r in got if r.query_id in (3, 4)]
    v = {r.query_id: r.reason for r in validate_requests(q).collect()}
    assert v == {1: None, 2: None, 3: "blank query", 4: "top_k above 100"}


def test_written_index_equals_lazy(spark, search_cases, tmp_path):
    lazy = _index(search_cases)
    stored = write_index(lazy, str(tmp_path / "idx"))
    assert _pairs(search_one(spark, stored, QUERY, 10).collect()) == \
        GOLDEN
    plan = stored.postings.where(F.col("dim").isin([2028, 5613]))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [In(dim, [2028,5613])]" in plan


def test_versions_latest_and_all(spark, search_cases, tmp_path):
    old = spark.createDataFrame([(1, 1, "Harbour crane brake", "old text only", "closed")],
                                "case_id long, customer_id long, title string, "
                                "description string, status string").withColumn("v", F.lit(0))
    new = search_cases.drop("updated_at").withColumn("v", F.lit(1))
    both = old.unionByName(new)
    latest = build_index(both, "case_id", ["title", "description"], ["title", "status"],
                         version_col="v")
    # the latest view is exactly the 8-case corpus
    assert _pairs(search_one(spark, latest, QUERY, 10).collect()) == \
        GOLDEN
    allv = build_index(both, "case_id", ["title", "description"], ["title", "status"],
                       version_col="v", versions="all")
    assert allv.n_docs.first().n == 9
    rows = search_one(spark, allv, QUERY, 10).collect()
    ones = [r for r in rows if r.case_id == 1]
    assert [r.status for r in ones] == ["closed", "open"]     # older version first
    assert ones[0].score == ones[1].score
    assert len(rows) == len(GOLDEN) + 1
    stored = write_index(allv, str(tmp_path / "allv"))
    assert stored.n_docs.first().n == 9
    assert [tuple(r) for r in search_one(spark, stored, QUERY, 10).collect()] == \
        [tuple(r) for r in rows]
    stored_latest = write_index(latest, str(tmp_path / "latest"))
    assert _pairs(search_one(spark, stored_latest, QUERY, 10).collect()) == \
        GOLDEN


def test_written_index_reopens_and_aggregates_without_shuffle(spark, search_cases, tmp_path):
    from tidemark.operators.index import _table_name, current_build, read_index
    path = str(tmp_path / "idx2")
    write_index(_index(search_cases), path, buckets=3)
    spark.sql(f"DROP TABLE {_table_name(current_build(spark, path))}")   # external: files stay
    idx = read_index(spark, path, ["title", "status"])
    assert _pairs(search_one(spark, idx, QUERY, 10).collect()) == \
        GOLDEN
    q = spark.createDataFrame([(1, QUERY)], "query_id long, query string")
    plan = search(idx, q, k_col=None)._jdf.queryExecution().executedPlan().toString()
    # the only shuffle is the per-query top-k after the partial group limit
    assert plan.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(query_id" in plan


def test_shuffle_join_path_matches_broadcast(spark, search_cases):
    idx = _index(search_cases)
    q = spark.createDataFrame([(1, QUERY), (2, "tide gauge drift")],
                              "query_id long, query string")
    a = search(idx, q, k_col=None).orderBy("query_id", "rank").collect()
    b_df = search(idx, q, k_col=None, broadcast_rows=0)
    plan = b_df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [dim" in plan or "ShuffledHashJoin [dim" in plan
    b = b_df.orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert "WindowGroupLimit" in search(idx, q, k_col=None)._jdf.queryExecution() \
        .executedPlan().toString()


def test_batch_default_k(spark, search_cases):
    idx = _index(search_cases)
    q = spark.createDataFrame([(1, QUERY)], "query_id long, query string")
    got = search(idx, q, k_col=None, default_k=2).orderBy("rank").collect()
    assert _pairs(got) == GOLDEN[:2]
    with pytest.raises(ValueError):
        search(idx, q, k_col=None, default_k=0)


def _both(index, q, **kw):
    rows = [search(index, q, bounded=b, **kw).orderBy("query_id", "rank").collect() for b in (False, True)]
    assert [tuple(r) for r in rows[0]] == [tuple(r) for r in rows[1]]
    return rows[0]


def _corpus(spark, n=1500, seed=3):
    """Texts of a few hot words each and some of many rare ones; junk, copies for ties."""
    rng = random.Random(seed)
    hot = lambda: f"hot{rng.randrange(12)}"
    rare = lambda: f"rare{rng.randrange(600)}"
    texts = [" ".join([hot() for _ in range(rng.randint(8, 30))] + [rare() for _ in range(rng.randint(0, 4))])
             for _ in range(n)]
    texts += texts[:50] + ["", "hot1", "hot1 hot1 hot1", "rare1 " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = [(i, " ".join([hot() for _ in range(rng.randint(1, 6))] + [rare() for _ in range(rng.randint(0, 2))]),
              rng.choice([1, 3, 5, 100])) for i in range(80)]
    asked += [(900, "xyzzy", 5), (901, " ", 5), (902, "hot1", 100), (903, "rare1 rare1", 2)]
    return docs, spark.createDataFrame(asked, "query_id long, query string, top_k int")


@pytest.mark.parametrize("share", [0.05, 1.0])
def test_bounded_search_gives_the_same_rows_from_fewer_pairs(spark, tmp_path, monkeypatch, share):
    monkeypatch.setattr("tidemark.operators.search.MAX_ESSENTIAL", share)
    docs, q = _corpus(spark)
    idx = write_index(build_index(docs), str(tmp_path / "idx"), buckets=3, bounds=True)
    rows = _both(idx, q)
    assert {r.query_id for r in rows} >= {0, 902, 903} and not [r for r in rows if r.query_id == 900]
    _both(idx, q, broadcast_rows=0)                      # nothing broadcast: hot dimensions shuffled
    _both(idx, q.select("query_id", "query"), k_col=None, default_k=7)
    req = q.where("top_k <= 5 and query like '%rare%'").withColumn("_k", F.col("top_k"))
    vectors = query_rows(req, "query", "query_id").checkpoint()
    found = bounded_pairs(idx, vectors, vectors.count(), req.count(), "query_id", 100_000)
    if share < 1:
        return
    every = vectors.join(idx.postings, "dim").select("query_id", "doc_id").distinct().count()
    assert 0 < found[1].count() < every / 3, (found[1].count(), every)


def test_completion_meets_the_vectors_without_an_exchange(spark, tmp_path):
    docs, q = _corpus(spark)
    idx = write_index(build_index(docs), str(tmp_path / "idx"), buckets=3, bounds=True)
    plan = search(idx, q, bounded=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(doc_id" not in plan and "WindowGroupLimit" in plan
    for plain in (build_index(docs), write_index(build_index(docs), str(tmp_path / "plain"))):
        with pytest.raises(ValueError):
            search(plain, q, bounded=True)


def test_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "harbour crane"), (1, "harbour storm"), (2, "storm lamp"), (3, "quay"),
                                  (None, "storm"), (None, "gale")], "doc_id long, text string")
    kept = docs.where("text not in ('harbour crane', 'gale')")
    q = spark.createDataFrame([(1, "harbour storm gale")], "query_id long, query string")
    for repeated in (build_index(docs), write_index(build_index(docs), str(tmp_path / "idx"))):
        got = search(repeated, q, k_col=None).orderBy("rank").collect()
        want = search(build_index(kept, repeated="trusted"), q, k_col=None).orderBy("rank").collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in want] and max(r.score for r in got) <= 1
        assert repeated.n_docs.first().n == 4
    with pytest.raises(RepeatedIds):
        build_index(docs, repeated="error")
    with pytest.raises(ValueError):
        build_index(docs, repeated="any")


def test_old_builds_are_removed(spark, search_cases, tmp_path):
    from tidemark.operators.index import current_build, expire_builds, read_index
    path = str(tmp_path / "idx")
    for _ in range(3):
        write_index(_index(search_cases), path, buckets=2)
    (tmp_path / "idx" / "build=half" / "terms").mkdir(parents=True)
    assert len(expire_builds(spark, path)) == 1                  # the oldest; the unpublished one is young
    assert expire_builds(spark, path, keep=1, older_than_ms=0) and not (tmp_path / "idx" / "build=half").exists()
    assert [p.name for p in (tmp_path / "idx").glob("build=*")] == [current_build(spark, path).rsplit("/", 1)[1]]
    idx = read_index(spark, path, ["title", "status"])
    assert _pairs(search_one(spark, idx, QUERY, 10).collect()) == GOLDEN
    with pytest.raises(ValueError):
        expire_builds(spark, path, keep=0)


def test_batches_in_cells_equal_the_join(spark, monkeypatch):
    """Ties at the cut, repeated request ids, null ids and texts, over several cells and blocks."""
    from tidemark.operators import blocks
    monkeypatch.setattr(blocks, "CELL_DOCS", 40)
    monkeypatch.setattr(blocks, "CELL_QUERIES", 5)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(25)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9))) if i % 4 else "w1 w2") for i in range(150)]
    docs += [(None, "w1 w3"), (1000, None), (1001, "")]
    df = spark.createDataFrame(docs, "id long, text string")
    asked = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 6))), 1 + i % 7) for i in range(20)]
    asked += [(3, "w9 w9 w1", 5), (4, "w2", 100), (None, "w1", 3), (30, "w1", None), (31, "nowhere", 2), (32, " ", 2)]
    req = spark.createDataFrame(asked, "query_id long, query string, top_k int")
    idx = build_index(df, "id")

    def rows(df):
        return sorted((r.query_id, r.rank, r.id if r.id is not None else -1, r.score) for r in df.collect())

    cells = search(idx, req)
    assert "CoGroup" in cells._jdf.queryExecution().optimizedPlan().toString()
    want = rows(search(idx, req, broadcast_rows=1000))
    assert rows(cells) == want and len(want) > 80
    assert rows(search(idx, req, default_k=2, k_col=None)) == rows(
        search(idx, req, default_k=2, k_col=None, broadcast_rows=1000))


def test_best_of_a_block_keeps_the_first_of_equal_scores():
    import numpy as np
    from tidemark.operators.blocks import _best
    scores = np.array([0.2, 0.0, 0.5, 0.2, 0.2, 0.1])
    found, rounded, low = _best(scores, 2, -1.0)
    assert sorted(found) == [0, 2] and low == 2e7
    assert not len(_best(scores[[1, 3, 5]], 2, low)[0])          # equal scores of later columns lose
    assert list(_best(scores, 10, -1.0)[0]) == [0, 2, 3, 4, 5]   # no shared dimension, no row


def test_buckets_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    import inspect
    from tidemark.operators import search as S
    assert inspect.signature(write_index).parameters["bucket_bytes"].default <= 8 << 20
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.lit("common"), F.concat(F.lit("word"), F.col("id") % 50)).alias("text"))
    counts = []
    for n in (100, 400):
        idx = write_index(build_index(docs.where(F.col("doc_id") < n)), str(tmp_path / f"i{n}"), bucket_bytes=500)
        counts.append(spark.read.json(f"{current_build(spark, str(tmp_path / f'i{n}'))}/meta").first()["buckets"])
    assert counts[1] > counts[0] >= 4
    asked = spark.createDataFrame([(1, "common word7"), (2, "word9")], "query_id long, query string")
    few = search(idx, asked, k_col=None)
    monkeypatch.setattr(S, "BUCKET_QUERIES", 1)
    many = search(idx, asked, k_col=None)                     # many requests: in cells
    assert "CoGroup" in many._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 10


def test_tasks_grow_with_the_cells_not_with_the_partitions_set(spark, monkeypatch):
    """A task gets about one cell, however few shuffle partitions are set or put together."""
    from tidemark.operators import blocks
    monkeypatch.setattr(blocks, "CELL_DOCS", 20)
    docs = spark.range(800).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.lit("common"), F.concat(F.lit("word"), F.col("id") % 50)).alias("text"))
    asked = spark.createDataFrame([(1, "common word7", 3), (2, "word9", 3)], "query_id long, query string, _k int")
    tasks = []
    for n in (400, 800):
        idx = build_index(docs.where(F.col("doc_id") < n))
        pairs = blocks.best_pairs(idx, asked, "query", "query_id", 2, 3)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        # one shuffle of documents and one of queries: the cogroup adds none of its own
        assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan
        tasks.append(pairs.rdd.getNumPartitions())
        assert sorted(map(tuple, search(idx, asked, k_col="_k").collect())) == sorted(
            map(tuple, search(idx, asked, k_col="_k", broadcast_rows=1000).collect()))
    assert tasks == [20, 40]


def test_many_requests_meet_larger_cells(spark, monkeypatch):
    """Every cell of documents gets a copy of the requests and gives back their best: with many
    requests a cell holds more documents, up to a bound, and the results are the same."""
    from tidemark.operators import blocks
    monkeypatch.setattr(blocks, "CELL_DOCS", 20)
    monkeypatch.setattr(blocks, "MOST_CELL_DOCS", 100, raising=False)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.lit("common"), F.concat(F.lit("word"), F.col("id") % 50)).alias("text"))
    idx = build_index(docs)
    for n, cells in ((5, 20), (40, 10), (300, 4)):
        asked = spark.range(n).select(F.col("id").alias("query_id"), F.concat_ws(
            " ", F.lit("common"), F.concat(F.lit("word"), F.col("id") % 60)).alias("query"),
            (F.col("id") % 9 + 1).cast("int").alias("_k"))
        assert blocks.best_pairs(idx, asked, "query", "query_id", n, 2 * n).rdd.getNumPartitions() == cells
        found = search(idx, asked, k_col="_k", broadcast_rows=1000).collect()
        assert sorted(map(tuple, search(idx, asked, k_col="_k").collect())) == sorted(map(tuple, found))


def test_scores_of_a_cell_by_matrix_and_by_postings(monkeypatch):
    """Common dimensions are multiplied, the others added up: the same scores, however they are split."""
    import numpy as np
    from tidemark.operators import blocks
    rng = np.random.default_rng(3)
    n, n_dims, n_queries = 70, 30, 11
    columns, d_dims = np.nonzero(rng.random((n, n_dims)) < 1 / np.arange(1, n_dims + 1))
    columns, d_dims = np.append(columns, columns[-3:]), np.append(d_dims, d_dims[-3:])    # an id twice: adds up
    rows, dims = np.nonzero(rng.random((n_queries, n_dims)) < 2 / np.arange(1, n_dims + 1))
    d_ws, ws = rng.random(len(d_dims)), rng.random(len(dims))
    docs, asked = np.zeros((n_dims, n)), np.zeros((n_queries, n_dims))
    np.add.at(docs, (d_dims, columns), d_ws)
    asked[rows, dims] = ws
    monkeypatch.setattr(blocks, "CHUNK", 4)
    for share, most in ((1 / 64, 512), (2.0, 512), (1 / 64, 2), (0.0, 512)):
        monkeypatch.setattr(blocks, "COMMON_SHARE", share)
        monkeypatch.setattr(blocks, "COMMON", most)
        parts = list(blocks._scored((np.searchsorted(rows, np.arange(n_queries + 1)), dims, ws),
                                    (columns, d_dims.astype(np.int16), d_ws), n, n_dims))
        assert [first for first, _ in parts] == [0, 4, 8]
        np.testing.assert_allclose(np.concatenate([s for _, s in parts]), asked @ docs, atol=1e-12)


def test_best_of_many_rows_at_once():
    """Every row has its own k and bound, wider than groups or not, with ties and rows without any."""
    import numpy as np
    from tidemark.operators.blocks import GROUP, _best
    rng = np.random.default_rng(4)
    for width in (5, GROUP, 10 * GROUP + 3):
        scores = np.round(rng.random((9, width)), 1) * (rng.random((9, width)) < 0.6)
        scores[4] = 0
        ks, low = rng.integers(1, 12, 9), np.where(np.arange(9) % 2, -1.0, 3e7)
        places, rounded, bounds = _best(scores, ks, low)
        want = []
        for r in range(9):
            found = [c for c in range(width) if scores[r, c] > 0 and round(scores[r, c] * 1e8) > low[r]]
            found = sorted(found, key=lambda c: (-scores[r, c], c))[:ks[r]]
            want += sorted(r * width + c for c in found)
            assert bounds[r] == (round(scores[r, found[-1]] * 1e8) if len(found) == ks[r] else low[r])
        assert places.tolist() == want and rounded.tolist() == [round(scores.flat[p] * 1e8) for p in want]
