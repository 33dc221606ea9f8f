import pytest
from pyspark.sql import functions as F

from tidemark.operators.changes import RepeatedKeys, apply_change_set, dense_ids, merge_updates
from tidemark.operators.quality import (domain_violations, duplicate_keys, null_counts,
                                        orphans)
from tidemark.operators.versions import latest_version


def test_quality_checks(spark):
    cases = spark.createDataFrame(
        [(1, 1, "open"), (2, 9, "closed"), (2, 1, "pending"), (3, None, None)],
        "case_id long, customer_id long, status string")
    customers = spark.createDataFrame([(1,), (2,)], "customer_id long")
    nulls = {r.column: r.violations for r in null_counts(cases, "cases").collect()}
    assert nulls == {"case_id": 0, "customer_id": 1, "status": 1}
    bad = domain_violations(cases, "status", ["open", "in_progress", "closed"])
    assert sorted(r.case_id for r in bad.collect()) == [2, 3]
    assert [(r.case_id, r.n) for r in duplicate_keys(cases, ["case_id"]).collect()] == [(2, 2)]
    assert [r.case_id for r in orphans(cases, customers, "customer_id", "customer_id")
            .collect()] == [2]


def test_dense_ids_are_consecutive(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = dense_ids(df, ["k"], 100, "new_id").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted((r.k, r.new_id) for r in out) == [(k, 101 + k) for k in range(1000)]


def test_apply_change_set(spark):
    target = spark.createDataFrame([(1, "a", "open"), (2, "b", "open"), (5, "c", "open")],
                                   "case_id long, title string, status string")
    updates = spark.createDataFrame([(2, "b", "closed"), (9, "x", "closed")],
                                    "case_id long, title string, status string")
    inserts = spark.createDataFrame([("n1", "open", 2), ("n0", "open", 1)],
                                    "title string, status string, seq int")
    out = apply_change_set(target, updates, inserts, "case_id", ["seq"]).orderBy("case_id")
    assert [tuple(r) for r in out.collect()] == [
        (1, "a", "open", "keep"), (2, "b", "closed", "update"), (5, "c", "open", "keep"),
        (6, "n0", "open", "insert"), (7, "n1", "open", "insert")]


def test_updates_change_the_given_columns_only(spark):
    target = spark.createDataFrame([(1, "Ann", "a@x", "NO"), (2, "Bo", None, "SE"), (None, "Cy", "c@x", "FI")],
                                   "id long, name string, email string, country string")
    updates = spark.createDataFrame([(1, "new@x"), (7, "no@x"), (None, "null@x")], "id long, email string")
    out = {r.name: r for r in merge_updates(target, updates, "id").collect()}
    assert tuple(out["Ann"]) == (1, "Ann", "new@x", "NO", True)
    assert tuple(out["Bo"]) == (2, "Bo", None, "SE", False)
    assert tuple(out["Cy"]) == (None, "Cy", "c@x", "FI", False) and len(out) == 3
    masked = spark.createDataFrame([(1, None, "DK", ["email"]), (2, "b@x", "DK", None)],
                                   "id long, email string, country string, given array<string>")
    out = {r.id: r for r in merge_updates(target, masked, "id", "given").collect()}
    assert (out[1].email, out[1].country) == (None, "NO")           # NULL given, country not
    assert (out[2].email, out[2].country) == ("b@x", "DK")
    flagged = apply_change_set(target, updates, target.limit(0).drop("id"), "id", ["name"])
    assert {r.name: r.change for r in flagged.collect()} == {"Ann": "update", "Bo": "keep", "Cy": "keep"}
    twice = updates.unionByName(spark.createDataFrame([(1, "other@x")], "id long, email string"))
    with pytest.raises(RepeatedKeys):
        merge_updates(target, twice, "id")
    with pytest.raises(ValueError):
        merge_updates(target, updates.withColumnRenamed("email", "mail"), "id")
    both = target.unionByName(target)                               # a target key twice: both rows
    assert merge_updates(both, updates, "id").where("_updated").count() == 2


def test_latest_version_hot_key(spark):
    # one key holds most rows; the partial aggregate keeps one per task
    df = spark.range(0, 5000).select(
        F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"), (F.col("id") * 2).alias("payload"))
    got = latest_version(df, "k", ["ts"]).where("k = 0").first()
    assert (got.ts, got.payload) == (3999, 7998)
    plan = latest_version(df, "k", ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


@pytest.mark.parametrize("how", [{}, {"spark.sql.adaptive.coalescePartitions.enabled": "false"},
                                 {"spark.sql.adaptive.enabled": "false"}])
def test_dense_ids_on_many_wide_rows(spark, tmp_path, how):
    from pyspark.sql import functions as F

    from tidemark.operators.changes import dense_ids
    n = 300_000
    path = str(tmp_path / "wide")
    spark.range(n).select(F.xxhash64("id").alias("k"), F.md5(F.col("id").cast("string")).alias("pad"),
                          "id").write.parquet(path)
    old = {k: spark.conf.get(k) for k in how}
    try:
        for k, v in how.items():
            spark.conf.set(k, v)
        out = dense_ids(spark.read.parquet(path), ["k"], 10, "new_id")
        got = out.agg(F.count("pad").alias("n"), F.countDistinct("new_id").alias("d"),
                      F.min("new_id").alias("lo"), F.max("new_id").alias("hi"),
                      F.countDistinct("id").alias("ids")).first()
        assert tuple(got) == (n, n, 11, 10 + n, n)
        early = out.where("new_id <= 20").orderBy("new_id").collect()
        assert [r.k for r in early] == sorted(r.k for r in early)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
