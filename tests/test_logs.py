from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE
from tidemark.functions.timefmt import py_iso
from tidemark.operators.versions import late_rows, late_rows_by_digest
from tidemark.sources import state as S


def event(i):
    return {"table": f"t{i % 3}", "run_id": f"r{i}", "schema_fingerprint": "f", "delta_row_count": i,
            "lake_paths": [f"p{i}"], "checkpoint_after": py_iso(BASE + timedelta(hours=i))}


def many_runs(spark, tmp_path, n):
    """A log as n runs leave it: a file each."""
    import json
    for name, row in (("state", lambda i: {"table": f"t{i % 3}", "checkpoint": event(i)["checkpoint_after"],
                                           "run_id": f"r{i}", "written_at": py_iso(BASE)}), ("events", event)):
        (tmp_path / name).mkdir()
        for i in range(n):
            (tmp_path / name / f"part-{i:05d}.json").write_text(json.dumps(row(i)) + "\n")
    return str(tmp_path / "state"), str(tmp_path / "events")


def marks(spark, path):
    return S.read_watermarks(spark, path, ["t0", "t1", "t2", "none"])


def logged(spark, path):
    return sorted((r.table, r.run_id, tuple(r.lake_paths)) for r in S.read_events(spark, path).collect())


def data_files(folder):
    return [p for p in folder.iterdir() if p.name.startswith("part-")]


def test_a_thousand_runs_fold_into_one_checkpoint(spark, tmp_path):
    state, events = many_runs(spark, tmp_path, 1000)
    before, told = marks(spark, state), logged(spark, events)
    assert S.compact_state(spark, state) == 1 and S.compact_events(spark, events) == 1
    assert marks(spark, state) == before and logged(spark, events) == told and len(told) == 1000
    assert not data_files(tmp_path / "state") and not data_files(tmp_path / "events")
    assert len(S.read_state(spark, state).inputFiles()) == 1 and S.read_state(spark, state).count() == 3
    # runs go on; the next read is the checkpoint and the tail
    S.write_watermarks(spark, state, {"t1": BASE + timedelta(days=900)}, "next")
    S.append_events(spark, events, [event(1001)], echo=False)
    assert marks(spark, state)["t1"] == BASE + timedelta(days=900) and len(logged(spark, events)) == 1001
    assert S.compact_state(spark, state) == 2 and S.compact_state(spark, state) == 2       # nothing new
    assert marks(spark, state)["t1"] == BASE + timedelta(days=900)
    assert len([p for p in (tmp_path / "state" / S.CHECKPOINTS).iterdir() if p.name.isdigit()]) == 1


@pytest.mark.parametrize("step", ["listed", "rows", "files", "published", "removed"])
def test_a_failure_at_any_step_keeps_marks_and_events(spark, tmp_path, step):
    state, events = many_runs(spark, tmp_path, 12)
    S.compact_events(spark, events, remove=False)          # a checkpoint beside the files it names
    S.append_events(spark, events, [event(50)], echo=False)
    before, told = marks(spark, state), logged(spark, events)
    assert len(told) == 13

    def dies(at):
        if at == step:
            raise RuntimeError(step)

    for fold, path in ((S.compact_state, state), (S.compact_events, events)):
        with pytest.raises(RuntimeError):
            fold(spark, path, hook=dies)
        assert marks(spark, state) == before and logged(spark, events) == told
        fold(spark, path)
        assert marks(spark, state) == before and logged(spark, events) == told


def test_the_same_run_written_twice_counts_once(spark, tmp_path):
    events = str(tmp_path / "e")
    for _ in range(2):
        S.append_events(spark, events, [event(1)], echo=False)
    S.compact_events(spark, events)
    S.append_events(spark, events, [event(1)], echo=False)
    S.compact_events(spark, events)
    assert len(logged(spark, events)) == 1


def test_unreadable_marks_are_left_behind(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "checkpoint.json").write_text('{"checkpoint": "2024-05-01T00:00:00+00:00"}\nnot json\n')
    (folder / "part-1.json").write_text('{"table": "t0", "checkpoint": "soon"}\n')
    before = marks(spark, str(folder))
    assert before["t0"].month == 5
    S.compact_state(spark, str(folder))
    assert marks(spark, str(folder)) == before


def test_digest_audit_joins_only_the_dates_that_differ(spark, tmp_path):
    src = spark.range(2000).select("id", (F.lit(BASE) + F.make_interval(hours=F.col("id").cast("int") % 480))
                                   .alias("ts"), F.lit("x").alias("note"))
    lost = (F.col("id") == 30) | (F.col("id") % 480 == 100)
    src.where(~lost).withColumn("date", F.date_format("ts", "yyyy-MM-dd")).write.partitionBy("date").parquet(
        str(tmp_path / "lake"))
    lake = spark.read.parquet(str(tmp_path / "lake")).withColumn("date", F.col("date").cast("string"))
    mark = BASE + timedelta(days=15)
    audit = late_rows_by_digest(src, lake, "id", "ts", mark)
    want = sorted(tuple(r) for r in late_rows(src, lake, "id", "ts", mark).collect())
    assert sorted(tuple(r) for r in audit.rows.collect()) == want and len(want) == 5
    assert audit.differ == ["2024-01-02", "2024-01-05"] and audit.dates == 16
    scan = next(line for line in audit.rows._jdf.queryExecution().executedPlan().toString().splitlines()
                if "FileScan parquet" in line)
    assert "PartitionFilters" in scan and "2024-01-05" in scan
    alike = late_rows_by_digest(src.where(~lost), lake, "id", "ts", mark)
    assert alike.differ == [] and alike.rows.count() == 0
    twice = lake.unionByName(lake.where("id = 1"))
    assert late_rows_by_digest(src, twice, "id", "ts", mark).rows.count() == 5
