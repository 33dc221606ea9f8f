from datetime import timedelta

from pyspark.sql import functions as F

from tests.conftest import BASE
from tidemark.sources import tenants as T

SCHEMA = "shop string, id long, ts timestamp, note string"


def rows(spark, *items):
    return spark.createDataFrame([(t, i, BASE + timedelta(hours=h), n) for t, i, h, n in items], SCHEMA)


def run(spark, df, tmp_path, lake=True):
    return T.run_tenant_ingest(spark, df, "shop", "id", "ts", str(tmp_path / "lake") if lake else None,
                               str(tmp_path / "marks"))


def stored(spark, tmp_path):
    return sorted((r.tenant, r.id, r.note) for r in T.read_tenant_lake(spark, str(tmp_path / "lake")).collect())


def test_every_tenant_has_its_own_mark(spark, tmp_path):
    run(spark, rows(spark, ("a", 1, 1, "x"), ("b", 2, 50, "y")), tmp_path)
    # behind b's mark but ahead of a's; a new tenant older than both; rows without tenant or time
    more = rows(spark, ("a", 1, 1, "x"), ("a", 3, 2, "late for b"), ("b", 4, 40, "behind"), ("c", 5, 0, "new"),
                (None, 6, 99, "no tenant")).unionByName(
        spark.createDataFrame([("a", 7, None, "no time")], SCHEMA))
    marks = T.read_marks(spark, str(tmp_path / "marks"))
    assert sorted(r.id for r in T.tenant_delta(more, marks, "shop", "ts").collect()) == [3, 5]
    run(spark, more, tmp_path)
    assert [r[1] for r in stored(spark, tmp_path)] == [1, 3, 2, 5]
    got = {r.tenant: r.mark for r in T.read_marks(spark, str(tmp_path / "marks")).selectExpr(
        "tenant", "unix_millis(mark) div 3600000 AS mark").collect()}
    start = int(BASE.timestamp()) // 3600
    assert got == {"a": start + 2, "b": start + 50, "c": start}
    run(spark, more, tmp_path)                                   # nothing new: nothing changes
    assert len(stored(spark, tmp_path)) == 4


def test_merge_keeps_rows_of_a_touched_date_and_repeats_safely(spark, tmp_path, monkeypatch):
    run(spark, rows(spark, ("a", 1, 1, "old"), ("a", 2, 2, "kept"), ("b", 9, 2, "other")), tmp_path)
    monkeypatch.setattr(T, "write_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("mark")))
    second = rows(spark, ("a", 1, 5, "new"))
    try:
        run(spark, second, tmp_path)
    except RuntimeError:
        pass
    monkeypatch.undo()
    run(spark, second, tmp_path)                                 # the run is simply repeated
    assert stored(spark, tmp_path) == [("a", 1, "new"), ("a", 2, "kept"), ("b", 9, "other")]


def test_scans_are_pushed_and_pruned(spark, tmp_path):
    df = rows(spark, *[(f"t{i % 5}", i, i, "n") for i in range(200)])
    df.write.parquet(str(tmp_path / "src"))
    src = spark.read.parquet(str(tmp_path / "src"))
    run(spark, src.where("id < 100"), tmp_path)
    plan = T.tenant_delta(src, T.read_marks(spark, str(tmp_path / "marks")), "shop", "ts")._jdf \
        .queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan and "BroadcastHashJoin" in plan
    run(spark, src, tmp_path)
    picked = T.read_marks(spark, str(tmp_path / "marks")).where(
        F.col("mark") >= F.lit(BASE + timedelta(hours=199))).select("tenant")
    read = T.read_tenant_lake(spark, str(tmp_path / "lake")).join(F.broadcast(picked), "tenant")
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 40


def test_a_hot_tenant_is_spread_over_files(spark, tmp_path):
    hot = spark.range(20000).select(F.when(F.col("id") % 50 < 40, F.lit("hot")).otherwise(F.lit("cold")).alias("shop"),
                                    "id", (F.lit(BASE) + F.make_interval(secs=F.col("id") % 80000)).alias("ts"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("note"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    run(spark, hot, tmp_path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f for f in T.read_tenant_lake(spark, str(tmp_path / "lake")).inputFiles() if "tenant=hot" in f]
    assert len(files) >= 4 and T.read_tenant_lake(spark, str(tmp_path / "lake")).count() == 20000


def test_marks_of_thousands_of_tenants_in_one_job(spark, tmp_path):
    many = spark.range(5000).select(F.concat(F.lit("t"), F.col("id")).alias("shop"), "id",
                                    F.lit(BASE).alias("ts"), F.lit("n").alias("note"))
    run(spark, many, tmp_path, lake=False)
    assert T.read_marks(spark, str(tmp_path / "marks")).count() == 5000
    assert len(list((tmp_path / "marks").glob("part-*"))) == 1
