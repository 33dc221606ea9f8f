import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans.ingest import run_ingest
from tidemark.sources import lake as lake_io
from tidemark.sources import state as state_io
from tidemark.specs import TableSpec


def _specs(customers, cases):
    return [TableSpec("customers", "customer_id", "updated_at", customers),
            TableSpec("cases", "case_id", "updated_at", cases)]


def _dirs(tmp_path):
    return (str(tmp_path / "lake"), str(tmp_path / "state"), str(tmp_path / "events"))


def _files(root):
    out = set()
    for d, _, fs in os.walk(root):
        out.update(os.path.join(d, f) for f in fs if f.endswith(".json"))
    return out


def test_first_run_advances_mark(spark, customers, cases, tmp_path):
    lake, st, ev = _dirs(tmp_path)
    m = run_ingest(spark, _specs(customers, cases), lake, st, ev, shared=True)
    assert [t.delta_row_count for t in m.tables] == [5, 5]
    assert m.checkpoint_before == "1970-01-01T00:00:00+00:00"
    assert m.checkpoint_after == "2024-01-06T00:00:00+00:00"
    assert m.table("cases").dates == [f"2024-01-0{d}" for d in range(2, 7)]
    assert [p.rsplit("/", 2)[-2:] for p in m.table("cases").lake_paths][0] == \
        ["cases", "date=2024-01-02"]
    persisted = state_io.read_watermarks(spark, st, [state_io.SHARED])[state_io.SHARED]
    assert persisted.isoformat() == m.checkpoint_after
    events = state_io.read_events(spark, ev).orderBy("table").collect()
    assert [(e.table, e.delta_row_count) for e in events] == [("cases", 5), ("customers", 5)]
    assert {e.run_id for e in events} == {m.run_id}


def test_second_run_is_empty_and_writes_nothing(spark, customers, cases, tmp_path):
    lake, st, ev = _dirs(tmp_path)
    first = run_ingest(spark, _specs(customers, cases), lake, st, ev, shared=True)
    before = _files(lake)
    second = run_ingest(spark, _specs(customers, cases), lake, st, ev, shared=True)
    assert [t.delta_row_count for t in second.tables] == [0, 0]
    assert all(t.lake_paths == [] for t in second.tables)
    assert second.checkpoint_after == first.checkpoint_after
    assert _files(lake) == before
    assert state_io.read_events(spark, ev).count() == 2


def test_failed_lake_write_leaves_mark(spark, customers, cases, tmp_path):
    lake, st, ev = _dirs(tmp_path)

    def boom(*args, **kwargs):
        raise OSError("disk full")

    with pytest.raises(OSError):
        run_ingest(spark, _specs(customers, cases), lake, st, ev, writer=boom)
    assert not os.path.exists(st)
    # the retry re-reads the whole delta
    m = run_ingest(spark, _specs(customers, cases), lake, st, ev)
    assert [t.delta_row_count for t in m.tables] == [5, 5]


def test_dry_run_mutates_nothing(spark, customers, cases, tmp_path):
    lake, st, ev = _dirs(tmp_path)
    m = run_ingest(spark, _specs(customers, cases), lake, st, ev, dry_run=True)
    assert [t.delta_row_count for t in m.tables] == [5, 5]
    assert all(t.lake_paths == [] for t in m.tables)
    assert m.checkpoint_after == m.checkpoint_before == "1970-01-01T00:00:00+00:00"
    assert not os.path.exists(lake) and not os.path.exists(st) and not os.path.exists(ev)


def test_per_table_marks_do_not_lose_rows(spark, customers, cases, tmp_path):
    lake, st, ev = _dirs(tmp_path)
    run_ingest(spark, _specs(customers, cases), lake, st, ev)
    marks = state_io.read_watermarks(spark, st, ["customers", "cases"])
    assert marks["customers"].isoformat() == "2024-01-06T00:00:00+00:00"
    # a late customer row below the cases mark but above its own mark is read
    late = customers.limit(1).withColumn("customer_id", F.lit(99).cast("long")).withColumn(
        "updated_at", F.lit("2024-01-06T00:00:01+00:00").cast("timestamp"))
    m = run_ingest(spark, _specs(customers.unionByName(late), cases), lake, st, ev)
    assert m.table("customers").delta_row_count == 1


def _lake_rows(spark, lake, table, schema):
    good, bad = lake_io.read_lake(spark, lake, table, schema, [schema.names[0]])
    assert bad.count() == 0
    return good


def test_replace_loses_rows_merge_keeps_them(spark, cases, tmp_path):
    schema = cases.schema
    early = cases.where(F.col("updated_at") <= F.lit("2024-01-05T00:00:00+00:00").cast(
        "timestamp"))
    # case 6 lands one hour after case 4, on case 4's (already written) date
    six = cases.where("case_id = 4").withColumn("case_id", F.lit(6).cast("long")) \
        .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 HOUR"))
    for mode, expected in (("replace", {1, 2, 3, 5, 6}), ("merge", {1, 2, 3, 4, 5, 6})):
        lake, st, ev = _dirs(tmp_path / mode)
        run_ingest(spark, [TableSpec("cases", "case_id", "updated_at", early)], lake, st, ev,
                   mode=mode)
        run_ingest(spark, [TableSpec("cases", "case_id", "updated_at", cases.unionByName(six))],
                   lake, st, ev, mode=mode)
        ids = {r.case_id for r in _lake_rows(spark, lake, "cases", schema).collect()}
        assert ids == expected, mode


def test_merge_dedups_replayed_rows(spark, cases, tmp_path):
    from datetime import datetime, timezone
    lake, st, ev = _dirs(tmp_path)
    spec = [TableSpec("cases", "case_id", "updated_at", cases)]
    run_ingest(spark, spec, lake, st, ev)
    run_ingest(spark, spec, lake, st, ev, since={"cases": datetime(1970, 1, 1,
                                                                    tzinfo=timezone.utc)})
    rows = _lake_rows(spark, lake, "cases", cases.schema)
    assert rows.count() == 5


def test_watermark_fallbacks(spark, tmp_path):
    def mark(text_lines, multiline=False):
        p = tmp_path / f"s{abs(hash(str(text_lines)))}"
        p.mkdir()
        (p / "checkpoint.json").write_text(text_lines)
        return state_io.read_watermarks(spark, str(p), ["t"], multiline)["t"].isoformat()

    epoch = "1970-01-01T00:00:00+00:00"
    assert mark('{"checkpoint": "not-a-ts"}') == epoch
    assert mark('{"other": "2024-01-01T00:00:00+00:00"}') == epoch
    assert mark("not json at all") == epoch
    assert mark('{"checkpoint": "2024-01-01T00:00:00"}') == "2024-01-01T00:00:00+00:00"
    assert mark('{\n  "checkpoint": "2026-03-18T12:14:47.312228+00:00"\n}', True) == \
        "2026-03-18T12:14:47.312228+00:00"
    assert state_io.read_watermarks(spark, str(tmp_path / "missing"), ["t"])["t"].isoformat() \
        == epoch


def test_malformed_lake_lines(spark, cases, tmp_path):
    d = tmp_path / "lake" / "cases" / "date=2024-01-02"
    d.mkdir(parents=True)
    good = ('{"case_id": 1, "customer_id": 1, "title": "t", "description": "d", '
            '"status": "open", "updated_at": "2024-01-02T00:00:00+00:00"}')
    coerced = good.replace('"case_id": 1', '"case_id": "7"')
    (d / "part-0.json").write_text("\n".join(
        [good, "", "   ", "not json", coerced, '{"title": "nokey"}']) + "\n")
    ok, bad = lake_io.read_lake(spark, str(tmp_path / "lake"), "cases", cases.schema,
                                ["case_id", "updated_at"])
    assert sorted(r.case_id for r in ok.collect()) == [1, 7]
    raws = sorted(r.raw for r in bad.collect())
    assert raws[0] == "not json"
    assert json.loads(raws[1]) == {"title": "nokey"}


def test_shared_mark_skips_rows_per_table_marks_read_them(spark, customers, cases, tmp_path):
    # customers end on day 3, cases on day 5; a customer row stamped day 4
    # arrives after the first run
    early_customers = customers.where("customer_id <= 2")
    late = customers.where("customer_id = 4")
    for shared, expected in ((True, 0), (False, 1)):
        lake, st, ev = _dirs(tmp_path / str(shared))
        run_ingest(spark, _specs(early_customers, cases), lake, st, ev, shared=shared)
        m = run_ingest(spark, _specs(early_customers.unionByName(late), cases), lake, st, ev,
                       shared=shared)
        assert m.table("customers").delta_row_count == expected, shared


@pytest.mark.parametrize("left", ["_temporary/0/x", "date=2024-01-02/_temporary/x", "date=2024-01-02/.part-0.crc"])
def test_a_failed_first_write_can_be_repeated(spark, cases, tmp_path, left):
    lake, st, ev = _dirs(tmp_path)

    def dies(*args, **kw):
        path = tmp_path / "lake" / "cases" / left
        path.parent.mkdir(parents=True)
        path.write_text("half a line")
        raise RuntimeError("disk full")

    spec = [TableSpec("cases", "case_id", "updated_at", cases)]
    with pytest.raises(RuntimeError):
        run_ingest(spark, spec, lake, st, ev, writer=dies)
    m = run_ingest(spark, spec, lake, st, ev)
    assert m.table("cases").delta_row_count == 5
    assert _lake_rows(spark, lake, "cases", cases.schema).count() == 5


def test_merge_keeps_files_of_other_writers(spark, cases, tmp_path):
    """A lake whose files another program named is merged, not taken for empty."""
    lake, st, ev = _dirs(tmp_path)
    d = tmp_path / "lake" / "cases" / "date=2024-01-02"
    d.mkdir(parents=True)
    (d / "data.jsonl").write_text('{"case_id": 77, "title": "old", "updated_at": "2024-01-02T00:00:00+00:00"}\n')
    run_ingest(spark, [TableSpec("cases", "case_id", "updated_at", cases)], lake, st, ev)
    assert _lake_rows(spark, lake, "cases", cases.schema).where("case_id = 77").count() == 1
