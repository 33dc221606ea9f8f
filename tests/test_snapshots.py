import json
import threading
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE
from tidemark.plans.ingest import run_ingest
from tidemark.sources import snapshots as S
from tidemark.specs import TableSpec

SCHEMA = "id long, day int, note string, ts timestamp"


def rows(spark, *items):
    return spark.createDataFrame([(i, d, n, BASE + timedelta(days=d, minutes=m)) for i, d, n, m in items], SCHEMA)


def dates(*days):
    return [(BASE + timedelta(days=d)).strftime("%Y-%m-%d") for d in days]


def stored(spark, root, number=None):
    df = S.read_snapshot(spark, root, "t", rows(spark, (1, 0, "", 0)).schema, number)
    return sorted((r.id, r.note, r.date) for r in df.collect())


def write(spark, root, df, *days, **kw):
    return S.write_snapshot(spark, df, root, "t", "id", "ts", dates(*days), **kw)


def test_versions_are_whole_and_stay_readable(spark, tmp_path):
    root = str(tmp_path)
    assert stored(spark, root) == [] and S.version(spark, root, "t").number == 0
    write(spark, root, rows(spark, (1, 0, "a", 0), (2, 1, "b", 0)), 0, 1)
    write(spark, root, rows(spark, (2, 1, "b2", 5), (3, 1, "c", 1), (4, 2, "d", 0)), 1, 2)
    d0, d1, d2 = dates(0, 1, 2)
    assert stored(spark, root) == [(1, "a", d0), (2, "b2", d1), (3, "c", d1), (4, "d", d2)]
    assert stored(spark, root, 1) == [(1, "a", d0), (2, "b", d1)]
    write(spark, root, rows(spark, (9, 1, "z", 0)), 1, mode="replace")
    assert stored(spark, root) == [(1, "a", d0), (4, "d", d2), (9, "z", d1)]
    write(spark, root, rows(spark, (9, 1, "older", -30)).withColumn("ts", F.lit(BASE + timedelta(days=1))), 1)
    assert [r for r in stored(spark, root) if r[0] == 9] == [(9, "older", d1)]      # a tie: the delta wins
    with pytest.raises(FileNotFoundError):
        S.version(spark, root, "t", 77)


@pytest.mark.parametrize("step", ["read", "written", "ready"])
def test_a_failure_at_any_step_leaves_the_old_version(spark, tmp_path, step):
    root = str(tmp_path)
    write(spark, root, rows(spark, (1, 0, "a", 0)), 0)
    before = stored(spark, root)

    def dies(at):
        if at == step:
            raise RuntimeError(step)

    with pytest.raises(RuntimeError):
        write(spark, root, rows(spark, (1, 0, "new", 9), (2, 1, "b", 0)), 0, 1, hook=dies)
    assert stored(spark, root) == before and S.version(spark, root, "t").number == 1
    done = write(spark, root, rows(spark, (1, 0, "new", 9), (2, 1, "b", 0)), 0, 1)
    assert done.number == 2 and [r[1] for r in stored(spark, root)] == ["new", "b"]


@pytest.mark.parametrize("other_day,rewritten", [(0, 2), (1, 1)])
def test_of_two_writers_one_wins_and_one_tries_again(spark, tmp_path, other_day, rewritten):
    root = str(tmp_path)
    write(spark, root, rows(spark, (1, 0, "a", 0)), 0)
    steps, raced = [], []

    def race(at):
        steps.append(at)
        if at == "written" and not raced:               # the other writer publishes first
            raced.append(write(spark, root, rows(spark, (2, other_day, "other", 0)), other_day))

    done = write(spark, root, rows(spark, (3, 0, "mine", 0)), 0, hook=race)
    assert raced[0].number == 2 and done.number == 3 and done.parent == 2
    assert {r[1] for r in stored(spark, root)} == {"a", "other", "mine"}            # nothing lost
    assert steps.count("written") == rewritten           # merged again only if it was the same date
    assert steps.count("ready") == 2 and steps.count("published") == 1


def test_writers_in_threads_lose_nothing(spark, tmp_path):
    root, errors = str(tmp_path), []

    def one(i):
        try:
            write(spark, root, rows(spark, (i, 0, f"w{i}", i)), 0, attempts=20)
        except Exception as error:                       # shown by the assertion
            errors.append(error)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and [r[0] for r in stored(spark, root)] == [0, 1, 2, 3]
    assert S.version(spark, root, "t").number == 4


def test_an_endless_race_is_given_up(spark, tmp_path):
    root = str(tmp_path)

    def always(at):
        if at == "ready":
            n = S.version(spark, root, "t").number + 1
            (tmp_path / "t" / "versions" / f"{n:012d}.json").write_text(
                json.dumps({"parent": n - 1, "commit": "x", "dates": {}}))

    with pytest.raises(S.Conflict):
        write(spark, root, rows(spark, (1, 0, "a", 0)), 0, hook=always, attempts=2)


def test_ingest_into_snapshots_and_expiry(spark, cases, tmp_path):
    root = str(tmp_path / "lake")
    spec = [TableSpec("cases", "case_id", "updated_at", cases)]
    m = run_ingest(spark, spec, root, str(tmp_path / "s"), str(tmp_path / "e"), writer=S.snapshot_writer,
                   echo=False)
    got = S.read_snapshot(spark, root, "cases", cases.schema)
    assert got.count() == 5 and len(m.table("cases").lake_paths) == 5
    pruned = S.read_snapshot(spark, root, "cases", cases.schema, dates=["2024-01-03"])
    assert [r.case_id for r in pruned.collect()] == [2] and len(pruned.inputFiles()) == 1
    for i in range(3):
        S.write_snapshot(spark, cases.withColumn("title", F.lit(f"t{i}")), root, "cases", "case_id",
                         "updated_at", ["2024-01-02"], mode="replace")
    assert S.expire(spark, root, "cases", keep=1) == []                 # all are young
    gone = S.expire(spark, root, "cases", keep=1, older_than_ms=0)
    assert len(gone) == 2 and S.version(spark, root, "cases").number == 4
    assert S.read_snapshot(spark, root, "cases", cases.schema).count() == 5
    with pytest.raises(FileNotFoundError):
        S.version(spark, root, "cases", 1)
