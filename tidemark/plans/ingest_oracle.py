"""DuckDB oracles for the ingest / lake queries."""

from __future__ import annotations

from tidemark.plans.oracle import LATEST_CONV, index_ctes, search_sql


def iso(x: str) -> str:
    """ISO-8601 text as the lake stores it (fraction only when non-zero)."""
    return (f"(strftime({x}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({x}) % 1000000 <> 0 "
            f"THEN '.' || strftime({x}, '%f') ELSE '' END || '+00:00')")


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


_TYPE = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'integer' "
         "WHEN 'DOUBLE' THEN 'double precision' WHEN 'VARCHAR' THEN 'text' "
         "WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamptz' "
         "WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(column_type) END")


def fingerprint(table: str) -> str:
    return (f"(SELECT sha256(string_agg(column_name || ':' || t, '|' ORDER BY column_name, t)) "
            f"FROM (SELECT column_name, {_TYPE} AS t FROM (DESCRIBE {table})))")


def paths(table: str, ts: str) -> str:
    return (f"(SELECT string_agg('{table}/date=' || d, ',' ORDER BY d) FROM "
            f"(SELECT DISTINCT {day(ts)} AS d FROM {table}))")


EPOCH = "'1970-01-01T00:00:00+00:00'"
EV_COLS = (f"event_id, {iso('ts')} AS ts, user_id, event_type, value, props, "
           f"{day('ts')} AS date")
CUT = "TIMESTAMP '2024-01-15 12:00:00'"


def _manifest(dry: bool) -> str:
    parts = []
    for t, ts in (("events", "ts"), ("orders", "o_orderdate")):
        after = EPOCH if dry else iso(f"max({ts})")
        lp = "''" if dry else paths(t, ts)
        parts.append(
            f"SELECT '{t}' AS \"table\", count(*)::BIGINT AS delta_row_count, {lp} AS lake_paths, "
            f"{fingerprint(t)} AS schema_fingerprint, {EPOCH} AS checkpoint_before, "
            f"{after} AS checkpoint_after, {str(dry).lower()} AS dry_run FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _marks() -> str:
    return (f"SELECT 'events' AS \"table\", {iso('max(ts)')} AS checkpoint FROM events "
            f"UNION ALL SELECT 'orders', {iso('max(o_orderdate)')} FROM orders")


INGEST_ORACLE = {
    "incremental_delta": f"SELECT {EV_COLS} FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'",
    "partition_plan": f"""
SELECT {day('ts')} AS date, count(*)::BIGINT AS rows FROM events
WHERE ts > TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1""",
    "high_water_mark": f"""
SELECT 'events' AS "table", count(*)::BIGINT AS delta_row_count,
       '2024-01-20T00:00:00+00:00' AS checkpoint_before,
       coalesce({iso('max(ts)')}, '2024-01-20T00:00:00+00:00') AS checkpoint_after
FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
UNION ALL
SELECT 'orders', count(*)::BIGINT, '1998-01-01T00:00:00+00:00',
       coalesce({iso('max(o_orderdate)')}, '1998-01-01T00:00:00+00:00')
FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
UNION ALL
SELECT '*', (SELECT count(*) FROM events WHERE ts > TIMESTAMP '1998-01-01')
          + (SELECT count(*) FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'),
       '1998-01-01T00:00:00+00:00',
       {iso('greatest((SELECT max(ts) FROM events WHERE ts > TIMESTAMP %s), (SELECT max(o_orderdate) FROM orders WHERE o_orderdate > TIMESTAMP %s))' % ("'1998-01-01'", "'1998-01-01'"))}""",
    "dry_run_manifest": _manifest(True),
    "run_manifest": _manifest(False),
    "event_log": f"""
SELECT 'events' AS "table", count(*)::BIGINT AS delta_row_count,
       count(DISTINCT {day('ts')})::BIGINT AS n_paths, {fingerprint('events')} AS schema_fingerprint,
       {iso('max(ts)')} AS checkpoint_after FROM events
UNION ALL
SELECT 'orders', count(*)::BIGINT, count(DISTINCT {day('o_orderdate')})::BIGINT,
       {fingerprint('orders')}, {iso('max(o_orderdate)')} FROM orders""",
    "watermark_state": _marks(),
    "recover_watermark": _marks(),
    "lake_round_trip": f"SELECT {EV_COLS} FROM events",
    "lake_replace_two_runs": f"""
SELECT {EV_COLS} FROM events WHERE ts > {CUT} OR CAST(ts AS DATE) <> DATE '2024-01-15'""",
    "lake_merge_two_runs": f"SELECT {EV_COLS} FROM events",
    "late_row_audit": f"""
SELECT {EV_COLS} FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND ts <= {CUT}""",
    "latest_version": f"""
SELECT user_id, event_id, {iso('ts')} AS ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
                           ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC,
                                    props DESC) = 1""",
    "props_decode": """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       coalesce(json_valid(props), false) AS valid_json FROM events""",
}

INGEST_ORACLE["lake_compaction"] = INGEST_ORACLE["lake_round_trip"]
INGEST_ORACLE["malformed_records"] = f"""
SELECT {day('ts')} AS date, count(*) FILTER (WHERE event_id % 13 <> 0)::BIGINT AS readable,
       count(*) FILTER (WHERE event_id % 13 <> 0)::BIGINT AS ids,
       count(*) FILTER (WHERE event_id % 13 = 0)::BIGINT AS malformed FROM events GROUP BY 1"""
INGEST_ORACLE["lake_merge_malformed"] = f"""
SELECT {day('ts')} AS date, count(*)::BIGINT AS readable, count(*)::BIGINT AS ids,
       count(*) FILTER (WHERE event_id % 13 = 0)::BIGINT AS malformed FROM events GROUP BY 1"""

INGEST_ORACLE["search_from_lake"] = search_sql(
    "ev AS (SELECT event_id, event_type, coalesce(event_type, '') || ' ' || coalesce(props, '') "
    "AS text FROM events), q AS (SELECT 0 AS query_id, 'purchase 42 error' AS query)", 50,
    "SELECT rk.doc_id AS event_id, rank, score, event_type FROM rk "
    "JOIN ev ON ev.event_id = rk.doc_id WHERE rank <= {k}", table="ev", id_col="event_id")
INGEST_ORACLE["watermark_fallback"] = f"""
SELECT event_type || '_' || (event_id % 3) AS "table", CASE event_id % 3
         WHEN 0 THEN {iso('max(ts)')}
         WHEN 1 THEN {iso("date_trunc('second', max(ts))")}
         ELSE {EPOCH} END AS checkpoint
FROM events GROUP BY event_type, event_id % 3"""
INGEST_ORACLE["stream_versions"] = f"""
WITH {LATEST_CONV},{index_ctes('latest', 'conv_id')}
SELECT w.doc_id AS conv_id, dim, round(w, 8) AS w, latest.role
FROM w JOIN latest ON latest.conv_id = w.doc_id"""
