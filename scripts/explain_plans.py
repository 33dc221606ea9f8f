"""Write PLANS.md: physical plans of the main operators (sf0.01 inputs).

usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.index import build_index, write_index  # noqa: E402
from tidemark.operators import freshness  # noqa: E402
from tidemark.operators.search import query_vectors, search, search_one  # noqa: E402
from tidemark.operators.versions import latest_version  # noqa: E402
from tidemark.plans.ingest import delta_summary  # noqa: E402
from tidemark.plans.ingest_queries import EVENTS_MARK, events_spec, orders_spec  # noqa: E402
from tidemark.plans.quality_queries import q_dq_foreign_key  # noqa: E402
from tidemark.plans.queries import benchmark_queries, load  # noqa: E402
from tidemark.plans.service_queries import _order_runs, lagged_events  # noqa: E402
from tidemark.session import get_session, scratch_path  # noqa: E402
from tidemark.sources import tenants  # noqa: E402
from tidemark.streaming.segments import segment_index, start_segments  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = [ln for ln in details.splitlines()
            if ln.startswith("(") or "PushedFilters" in ln or "PartitionFilters" in ln
            or "ReadSchema" in ln or ln.startswith("Arguments: hashpartitioning")
            or "WindowGroupLimit" in ln]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    docs = load(spark, sf_dir, "documents")
    lazy = build_index(docs)
    idx = write_index(lazy, scratch_path(spark, "plans-index"))
    qv = query_vectors(spark.createDataFrame([(0, "the of and")], "query_id int, query string"))
    dims = [r.dim for r in qv.select("dim").collect()]
    ev = load(spark, sf_dir, "events")
    sections = [
        ("Index: term vectors (in-row TF, no shuffle)", lazy.terms),
        ("Index: document frequencies (partial aggregate, <= 16,384 keys)", lazy.doc_freq),
        ("Index: postings from stored terms (weights in-row, idf as scalar subquery)",
         idx.postings.where(F.lit(True))),
        ("Single query: dim IN (...) reaches the postings scan",
         idx.postings.where(F.col("dim").isin(dims)).join(F.broadcast(qv), "dim")
         .groupBy("query_id", "doc_id").agg(F.sum(F.col("qtf") * F.col("w")).alias("dot"))
         .orderBy(F.col("dot").desc(), "doc_id").limit(10)),
        ("Batch search: broadcast query side, partial WindowGroupLimit before the shuffle",
         search(idx, benchmark_queries(spark, sf_dir), k_col=None)),
        ("Ingest summary: pushed watermark filters, one job for all tables",
         delta_summary(spark, [events_spec(spark, sf_dir), orders_spec(spark, sf_dir)],
                       {"events": EVENTS_MARK, "orders": EVENTS_MARK})),
        ("Latest version: partial max(struct) per key (skew-safe)",
         latest_version(ev, "user_id", ["ts"])),
        ("Foreign keys: anti-joins on key columns only", q_dq_foreign_key(spark, sf_dir)),
    ]
    root = scratch_path(spark, "plans-service")
    landed = docs.select("doc_id", "text")
    landed.write.parquet(f"{root}/landing")
    start_segments(spark, f"{root}/landing", landed.schema, f"{root}/segments",
                   f"{root}/stream").awaitTermination()
    orders, early, marks = _order_runs(spark, sf_dir)
    tenants.run_tenant_ingest(spark, early, "o_custkey", "o_orderkey", "o_orderdate", None, marks)
    tenants.run_tenant_ingest(spark, ev, "event_type", "event_id", "ts", f"{root}/lake", f"{root}/marks")
    ahead = tenants.read_marks(spark, f"{root}/marks").where(
        F.col("mark") > F.lit("2024-01-30 23:59:00").cast("timestamp")).select("tenant")
    sections += [
        ("Stored segments: live rows weighed with summed counts; no tokenising, no corpus aggregate",
         search_one(spark, segment_index(spark, f"{root}/segments"), "the of and", 10)),
        ("Tenant delta: the least mark reaches the scan, marks are joined",
         tenants.tenant_delta(orders, tenants.read_marks(spark, marks), "o_custkey", "o_orderdate")),
        ("Tenant lake: partitions pruned at run time by a joined table of tenants",
         tenants.read_tenant_lake(spark, f"{root}/lake").join(F.broadcast(ahead), "tenant")),
        ("Freshness: one partial aggregate per window, sketches merged from stored ones",
         freshness.sketch_report(freshness.sketches(lagged_events(spark, sf_dir)))),
    ]
    out = ["# Physical plans", "",
           f"Generated by `scripts/explain_plans.py` on `{sf_dir}` (local[8], AQE on; "
           "final plans may change at run time).", "",
           "The `REPARTITION_BY_NUM` exchange under the index plans is the small-input "
           "spread of `_parallel_input`: the test files are one Parquet row group, so the "
           "scan has fewer partitions than cores.  A large input is not reshuffled.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
