"""Command line: the ingest and search calls as one-shot Spark jobs.

    python -m tidemark ingest --lake L --state S --events E \\
        --table customers:customer_id:updated_at:/data/customers \\
        --table cases:case_id:updated_at:/data/cases [--dry-run] [--mode merge|replace] [--shared]
    python -m tidemark index --lake L --table cases:case_id:updated_at:/data/cases \\
        --text title,description --payload title,status --out /index/cases
    python -m tidemark search --index /index/cases --payload title,status \\
        --query "billing fraud" [--top-k 5]

Sources are Parquet paths; ``--columns cases=case_id,title,updated_at`` reads only
those columns of a table.  Output is JSON on stdout: one line per event and then
the manifest, the index folder with the number of quarantined lines, or one line per result.
"""

from __future__ import annotations

import argparse
import json
import sys

from tidemark.functions.timefmt import py_iso
from tidemark.operators.index import build_index, read_index, write_index
from tidemark.operators.search import DEFAULT_TOP_K, search_one
from tidemark.plans.ingest import run_ingest
from tidemark.session import get_session
from tidemark.sources import lake as lake_io
from tidemark.specs import TableSpec, parquet_source


def _spec(text: str, columns: list[str]) -> TableSpec:
    name, key, ts, path = text.split(":", 3)
    chosen = {n: tuple(_list(c)) for n, c in (x.split("=", 1) for x in columns)}
    return TableSpec(name, key, ts, parquet_source(path), columns=chosen.get(name))


def _list(text: str | None) -> list[str]:
    return [c for c in (text or "").split(",") if c]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--lake", required=True)
    ing.add_argument("--state", required=True)
    ing.add_argument("--events", required=True)
    ing.add_argument("--table", action="append", required=True)
    ing.add_argument("--columns", action="append", default=[])
    ing.add_argument("--mode", default="merge", choices=["merge", "replace"])
    ing.add_argument("--dry-run", action="store_true")
    ing.add_argument("--shared", action="store_true")
    idx = sub.add_parser("index")
    idx.add_argument("--lake", required=True)
    idx.add_argument("--table", required=True)
    idx.add_argument("--columns", action="append", default=[])
    idx.add_argument("--text", required=True)
    idx.add_argument("--payload", default="")
    idx.add_argument("--versions", default="latest", choices=["latest", "all"])
    idx.add_argument("--out", required=True)
    srch = sub.add_parser("search")
    srch.add_argument("--index", required=True)
    srch.add_argument("--payload", default="")
    srch.add_argument("--versions", default="latest", choices=["latest", "all"])
    srch.add_argument("--query", required=True)
    srch.add_argument("--top-k", type=int, default=DEFAULT_TOP_K)
    a = p.parse_args(argv)
    spark = get_session()

    if a.cmd == "ingest":
        m = run_ingest(spark, [_spec(t, a.columns) for t in a.table], a.lake, a.state, a.events,
                       mode=a.mode, dry_run=a.dry_run, shared=a.shared)
        print(json.dumps({
            "run_id": m.run_id, "started_at": py_iso(m.started_at),
            "finished_at": py_iso(m.finished_at), "dry_run": m.dry_run,
            "tables": {t.table: {"delta_row_count": t.delta_row_count,
                                 "lake_paths": t.lake_paths,
                                 "schema_fingerprint": t.schema_fingerprint,
                                 "checkpoint_before": t.checkpoint_before,
                                 "checkpoint_after": t.checkpoint_after} for t in m.tables},
        }, ensure_ascii=False))
    elif a.cmd == "index":
        spec = _spec(a.table, a.columns)
        schema = spec.read(spark).schema
        rows, bad = lake_io.read_lake(spark, a.lake, spec.name, schema, spec.required_columns())
        write_index(build_index(rows, spec.key, _list(a.text), _list(a.payload),
                                version_col=spec.ts, versions=a.versions), a.out)
        print(json.dumps({"index": a.out, "quarantined": bad.count()}))
    else:
        index = read_index(spark, a.index, _list(a.payload), a.versions == "all")
        for r in search_one(spark, index, a.query, a.top_k).collect():
            print(json.dumps(r.asDict(), ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
