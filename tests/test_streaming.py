from datetime import timedelta

import pytest

from tests.conftest import BASE
from tidemark.operators.index import build_index
from tidemark.operators.quality import same_rows
from tidemark.operators.search import search_one
from tidemark.streaming.dedup import start_dedup
from tidemark.streaming.refresh import compact_refresh, refreshed_index, start_refresh
from tidemark.streaming.segments import compact_segments, segment_index, start_segments


def test_stream_refresh_equals_batch_build(spark, search_cases, tmp_path):
    docs = search_cases.select("case_id", "title", "description")
    landing = str(tmp_path / "landing")
    docs.where("case_id <= 4").write.parquet(landing)
    docs.where("case_id > 4").write.mode("append").parquet(landing)
    q = start_refresh(spark, landing, docs.schema, str(tmp_path / "index"),
                      str(tmp_path / "ckpt"), id_col="case_id",
                      text_cols=["title", "description"], max_files_per_trigger=1)
    q.awaitTermination()
    streamed = refreshed_index(spark, str(tmp_path / "index"))
    batch = build_index(docs, "case_id", ["title", "description"])
    assert same_rows(streamed.postings, batch.postings)
    # a second run of the stream finds nothing new and changes nothing
    q2 = start_refresh(spark, landing, docs.schema, str(tmp_path / "index"),
                       str(tmp_path / "ckpt"), id_col="case_id",
                       text_cols=["title", "description"])
    q2.awaitTermination()
    assert same_rows(refreshed_index(spark, str(tmp_path / "index")).postings, batch.postings)
    # compaction keeps one vector per id and the same index
    top = compact_refresh(spark, str(tmp_path / "index"))
    from tidemark.operators.index import current_build
    terms = spark.read.parquet(current_build(spark, str(tmp_path / "index")) + "/terms")
    assert terms.count() == 8
    assert [r.batch_id for r in terms.select("batch_id").distinct().collect()] == [top]
    assert same_rows(refreshed_index(spark, str(tmp_path / "index")).postings, batch.postings)


def test_greatest_version_wins_inside_one_batch(spark, tmp_path):
    rows = [(1, 1, "zebra yak walrus", "old"), (1, 2, "harbour storm", "new"),
            (2, 1, "storm lamp", "only")]
    df = spark.createDataFrame(rows, "id long, v long, text string, tag string")
    landing = str(tmp_path / "landing")
    df.coalesce(1).write.parquet(landing)
    start_refresh(spark, landing, df.schema, str(tmp_path / "index"), str(tmp_path / "ckpt"),
                  id_col="id", version_col="v", payload_cols=["tag"]).awaitTermination()
    from tidemark.operators.search import search_one
    idx = refreshed_index(spark, str(tmp_path / "index"))
    got = search_one(spark, idx, "harbour", 5).collect()
    assert [(r.doc_id, r.tag) for r in got] == [(1, "new")]
    assert search_one(spark, idx, "zebra", 5).count() == 0


def _segments(spark, tmp_path, files, compact_after=(), **kw):
    """Rows (id, v, text, tag) landing file by file; the index after all of them."""
    schema = "id long, v long, text string, tag string"
    for n, rows in enumerate(files):
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        start_segments(spark, str(tmp_path / "landing"), df.schema, str(tmp_path / "index"),
                       str(tmp_path / "ckpt"), id_col="id", payload_cols=["tag"], **kw).awaitTermination()
        if n in compact_after:
            compact_segments(spark, str(tmp_path / "index"))
    return segment_index(spark, str(tmp_path / "index"))


LANDED = [[(1, 1, "zebra yak", "a1"), (2, 1, "storm lamp", "b1"), (3, 5, "harbour quay", "c5")],
          [(1, 2, "harbour storm", "a2"), (4, 1, "gale quay lamp", "d1")],
          [(3, 4, "walrus", "c4"), (2, 2, "lamp lamp quay", "b2"), (2, 3, "lamp gale", "b3"), (None, 1, "quay", "n1")],
          [(3, 5, "harbour wall", "c5b"), (5, 1, None, "e1")]]
NEWEST = [(1, "harbour storm", "a2"), (2, "lamp gale", "b3"), (3, "harbour wall", "c5b"),
          (4, "gale quay lamp", "d1"), (5, None, "e1"), (None, "quay", "n1")]


@pytest.mark.parametrize("compact_after", [(), (1,), (0, 2), (3,)])
def test_segments_equal_the_batch_index(spark, tmp_path, compact_after):
    idx = _segments(spark, tmp_path, LANDED, compact_after, version_col="v")
    want = build_index(spark.createDataFrame(NEWEST, "id long, text string, tag string"), "id", ["text"], ["tag"])
    assert same_rows(idx.postings, want.postings)
    assert same_rows(idx.doc_freq, want.doc_freq) and same_rows(idx.n_docs, want.n_docs)
    assert same_rows(idx.payload_rows, want.payload_rows)


def test_without_versions_the_newest_batch_wins(spark, tmp_path):
    idx = _segments(spark, tmp_path, [[(1, 9, "old storm", "a")], [(1, 1, "new gale", "b")]])
    assert [r.tag for r in search_one(spark, idx, "gale storm", 5).collect()] == ["b"]


def test_search_neither_tokenises_nor_counts_the_corpus(spark, tmp_path):
    idx = _segments(spark, tmp_path, LANDED, (1,), version_col="v")
    plan = search_one(spark, idx, "harbour storm", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "sha2(" not in plan
    for line in plan.splitlines():                       # counts, the packed idf, the scores, no other
        if "Aggregate" in line:
            assert any(x in line for x in ("[dim#", "collect_list", "[query_id#")), line


def test_a_repeated_batch_writes_the_same_segment(spark, tmp_path):
    from tidemark.streaming import segments as G
    idx = _segments(spark, tmp_path, LANDED[:3], version_col="v")
    before = [tuple(r) for r in idx.postings.orderBy("doc_id", "dim").collect()]
    batch = spark.createDataFrame(LANDED[2], "id long, v long, text string, tag string")
    write = G._segment_writer(str(tmp_path / "index"), "id", ["text"], "v", ["tag"])
    write(batch, 2)
    again = segment_index(spark, str(tmp_path / "index"))
    assert [tuple(r) for r in again.postings.orderBy("doc_id", "dim").collect()] == before


def test_a_batch_that_died_is_not_read(spark, tmp_path, monkeypatch):
    from tidemark.streaming import segments as G
    idx = _segments(spark, tmp_path, LANDED[:2], version_col="v")
    before = [tuple(r) for r in idx.postings.orderBy("doc_id", "dim").collect()]
    batch = spark.createDataFrame(LANDED[2], "id long, v long, text string, tag string")
    real = G._write

    def dies(df, path):
        if path.endswith("/counts"):
            raise RuntimeError("lost")
        real(df, path)

    write = G._segment_writer(str(tmp_path / "index"), "id", ["text"], "v", ["tag"])
    monkeypatch.setattr(G, "_write", dies)
    with pytest.raises(RuntimeError):
        write(batch, 2)
    monkeypatch.undo()
    half = segment_index(spark, str(tmp_path / "index"))
    assert [tuple(r) for r in half.postings.orderBy("doc_id", "dim").collect()] == before
    write(batch, 2)
    assert search_one(spark, segment_index(spark, str(tmp_path / "index")), "gale", 5).count() == 2


def _dedup(spark, tmp_path, *rows):
    df = spark.createDataFrame([(k, BASE + timedelta(minutes=m)) if m is not None else (k, None)
                                for k, m in rows], "key string, ts timestamp")
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
    start_dedup(spark, str(tmp_path / "landing"), df.schema, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                ["key"], "ts").awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).selectExpr(
        "key", f"(unix_seconds(ts) - {int(BASE.timestamp())}) div 60 AS m").collect()
    return sorted((r.key, r.m) for r in out)


def test_dedup_within_the_interval_across_restarts_and_late_rows(spark, tmp_path):
    got = _dedup(spark, tmp_path, ("a", 0), ("b", 1), ("a", 0), ("c", None), ("d", 20))
    assert got == [("a", 0), ("b", 1), ("d", 20)]
    # restarted: d is still known; a is past its interval; x is older than the watermark
    got = _dedup(spark, tmp_path, ("d", 23), ("a", 22), ("x", 2))
    assert got == [("a", 0), ("a", 22), ("b", 1), ("d", 20)]
    # the watermark follows batch by batch: e moves it past d's interval
    got = _dedup(spark, tmp_path, ("e", 60))
    got = _dedup(spark, tmp_path, ("d", 61))
    assert got == [("a", 0), ("a", 22), ("b", 1), ("d", 20), ("d", 61), ("e", 60)]


def test_refresh_spreads_a_file_over_the_cores(spark, tmp_path):
    """One file of one row group is tokenised by several tasks, each writing its own file."""
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('storm lamp w', id) AS text")
    docs.coalesce(1).write.parquet(str(tmp_path / "landing"))
    start_refresh(spark, str(tmp_path / "landing"), docs.schema, str(tmp_path / "index"),
                  str(tmp_path / "ckpt")).awaitTermination()
    terms = spark.read.parquet(str(tmp_path / "index" / "terms"))
    assert len(terms.inputFiles()) >= spark.sparkContext.defaultParallelism > 1
    assert same_rows(refreshed_index(spark, str(tmp_path / "index")).postings, build_index(docs).postings)
