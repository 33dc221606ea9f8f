import pytest
from pyspark.sql import functions as F

from tidemark.operators.index import build_index, read_index
from tidemark.operators.quality import same_rows
from tidemark.operators.search import search_one
from tidemark.plans.ingest import InvalidSourceRows, run_ingest
from tidemark.plans.pipeline import ingest_and_reindex, register_lake_views
from tidemark.sources import lake as lake_io
from tidemark.specs import TableSpec


def _specs(customers, cases):
    return [TableSpec("customers", "customer_id", "updated_at", customers),
            TableSpec("cases", "case_id", "updated_at", cases)]


def test_ingest_then_search_three_identical(spark, customers, cases, tmp_path):
    specs = _specs(customers, cases)
    res = ingest_and_reindex(spark, specs, str(tmp_path / "lake"), str(tmp_path / "st"),
                             str(tmp_path / "ev"), specs[1], ["title", "description"],
                             ["title", "status"], str(tmp_path / "idx"))
    assert res.rebuilt and res.error is None
    runs = [[(r.case_id, r.score, r.title) for r in
             search_one(spark, res.index, "storm lamp", 5).collect()] for _ in range(3)]
    assert runs[0] == runs[1] == runs[2]
    assert runs[0][0][0] == 2 and runs[0][0][2] == "Storm signal lamp"
    # nothing new: no rebuild, the index is kept
    again = ingest_and_reindex(spark, specs, str(tmp_path / "lake"), str(tmp_path / "st"),
                               str(tmp_path / "ev"), specs[1], ["title", "description"],
                               ["title", "status"], str(tmp_path / "idx2"), current=res.index)
    assert not again.rebuilt and again.index is res.index


def test_two_indexes_agree(spark, search_cases):
    a = build_index(search_cases, "case_id", ["title", "description"])
    b = build_index(search_cases, "case_id", ["title", "description"])
    assert same_rows(a.postings, b.postings)
    assert same_rows(a.doc_freq, b.doc_freq)


def test_invalid_source_rows_fail_the_run(spark, customers, cases, tmp_path):
    broken = cases.withColumn("case_id", F.when(F.col("case_id") == 3, None)
                              .otherwise(F.col("case_id")))
    with pytest.raises(InvalidSourceRows) as err:
        run_ingest(spark, _specs(customers, broken), str(tmp_path / "lake"),
                   str(tmp_path / "st"), str(tmp_path / "ev"))
    assert err.value.counts == {"cases": 1}
    assert not (tmp_path / "st").exists() and not (tmp_path / "lake").exists()


def test_sql_over_lake(spark, customers, cases, tmp_path):
    lake = str(tmp_path / "lake")
    run_ingest(spark, _specs(customers, cases), lake, str(tmp_path / "st"), str(tmp_path / "ev"))
    register_lake_views(spark, lake, {"cases": (cases.schema, ["case_id", "updated_at"]),
                                      "customers": (customers.schema, ["customer_id"])})
    got = spark.sql("""SELECT c.name, count(*) AS n FROM cases k
                       JOIN customers c USING (customer_id) GROUP BY c.name""").collect()
    assert sorted((r.name, r.n) for r in got) == [("Berth 1", 2), ("Berth 2", 2),
                                                  ("Berth 3", 1)]


@pytest.mark.parametrize("step", ["term_vectors", "document_frequencies", "to_postings", "publish"])
def test_failed_rebuild_keeps_the_old_index(spark, customers, cases, tmp_path, monkeypatch, step):
    paths = [str(tmp_path / x) for x in ("lake", "st", "ev")]
    early = cases.where("case_id <= 3")
    args = (["title", "description"], ["title"], str(tmp_path / "idx"))

    def run(source, current=None):
        specs = _specs(customers, source)
        return ingest_and_reindex(spark, specs, *paths, specs[1], *args, current=current)

    first = run(early)
    before = search_one(spark, first.index, "storm lamp", 5).collect()

    def broken(*_, **__):
        raise OSError("no space")
    monkeypatch.setattr(f"tidemark.operators.index.{step}", broken)
    second = run(cases, first.index)
    monkeypatch.undo()
    assert not second.rebuilt and isinstance(second.error, OSError)
    assert second.manifest.table("cases").delta_row_count == 2
    assert search_one(spark, second.index, "storm lamp", 5).collect() == before
    reopened = read_index(spark, str(tmp_path / "idx"), ["title"])
    assert search_one(spark, reopened, "storm lamp", 5).collect() == before


def test_compaction_keeps_unreadable_lines(spark, customers, cases, tmp_path):
    lake = str(tmp_path / "lake")
    run_ingest(spark, _specs(customers, cases), lake, str(tmp_path / "st"), str(tmp_path / "ev"))
    (tmp_path / "lake" / "cases" / "date=2024-01-02" / "part-x.json").write_text("not json")
    out = lake_io.compact(spark, lake, "cases", cases.schema, ["case_id", "updated_at"],
                          str(tmp_path / "out"), ts_col="updated_at")
    assert out.count() == 5
    assert [r.value for r in spark.read.text(str(tmp_path / "out_quarantine")).collect()] == ["not json"]
