"""DuckDB SQL stating each registered query independently of Spark.

The driver registers the parquet tables as views; these statements use
only those views.  Column names match the Spark queries exactly.
"""

from __future__ import annotations

# DuckDB lower-cases U+0130 to a plain "i"; Python and Java give "i" plus a
# combining dot (a separator), so the oracle rewrites that letter first.
_LOWER = "lower(replace(coalesce({x}, ''), chr(304), 'i' || chr(775)))"
_TOKENS = ("list_filter(regexp_split_to_array(" + _LOWER + ", '[^a-z0-9]+'), "
           "lambda x: length(x) >= 2)")
_DIM = "CAST((('0x' || substr(sha256({t}), 1, 8))::BIGINT % 16384) AS INTEGER)"


def tokens(x: str) -> str:
    return _TOKENS.format(x=x)


def dim(t: str) -> str:
    return _DIM.format(t=t)


def index_ctes(table: str = "documents", id_col: str = "doc_id", text: str = "text",
               n_from: str | None = None) -> str:
    """CTEs tf, dfreq, n, w, nm for a documents relation."""
    n_from = n_from or table
    return f"""
tok AS (SELECT {id_col} AS doc_id, unnest({tokens(text)}) AS tok FROM {table}),
tf AS (SELECT doc_id, {dim('tok')} AS dim, count(*)::DOUBLE AS tf FROM tok GROUP BY 1, 2),
dfreq AS (SELECT dim, count(*)::BIGINT AS df FROM tf GROUP BY 1),
n AS (SELECT count(*)::DOUBLE AS n FROM {n_from}),
idf AS (SELECT dim, ln(1 + n.n / (1.0 + df)) AS idf FROM dfreq, n),
w AS (SELECT tf.doc_id, tf.dim, tf.tf * idf.idf AS w FROM tf JOIN idf USING (dim)),
nm AS (SELECT doc_id, coalesce(nullif(sqrt(sum(w * w)), 0), 1.0) AS dn FROM w GROUP BY 1)"""


def query_ctes(queries: str) -> str:
    """CTEs qtf, qn for a relation ``queries(query_id, query)``."""
    return f"""
qtok AS (SELECT query_id, unnest({tokens('query')}) AS tok FROM {queries}),
qtf AS (SELECT query_id, {dim('tok')} AS dim, count(*)::DOUBLE AS qtf FROM qtok GROUP BY 1, 2),
qn AS (SELECT query_id, coalesce(nullif(sqrt(sum(qtf * qtf)), 0), 1.0) AS qn FROM qtf GROUP BY 1)"""


SCORES = """
sc AS (SELECT qtf.query_id, w.doc_id,
              round(sum(qtf.qtf * w.w) / (max(qn.qn) * max(nm.dn)), 8) AS score
       FROM qtf JOIN w USING (dim) JOIN qn USING (query_id) JOIN nm USING (doc_id)
       GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id
                                    ORDER BY score DESC, doc_id) AS rank FROM sc)"""


def search_sql(queries_cte: str, k: int | str, select: str,
               table: str = "documents", id_col: str = "doc_id", text: str = "text") -> str:
    return (f"WITH {queries_cte},{index_ctes(table, id_col, text)},"
            f"{query_ctes('q')},{SCORES}\n{select.format(k=k)}")


BENCH_Q = "q AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
CONV_REQ = ("req AS (SELECT conv_id * 1000 + turn AS query_id, text AS query, "
            "CAST(turn AS INTEGER) AS top_k FROM conversations WHERE role = 'user')")
CONV_SEARCH = CONV_REQ.replace("CAST(turn AS INTEGER)", "CAST(least(turn + 1, 100) AS INTEGER)")
LATEST_CONV = ("latest AS (SELECT * FROM conversations "
               "QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1)")

SEARCH_ORACLE = {
    "tokens": f"""
SELECT doc_id, CAST(len({tokens('text')}) AS BIGINT) AS n_tokens,
       array_to_string({tokens('text')}, ' ') AS tokens
FROM documents""",
    "token_dims": f"""
WITH t AS (SELECT unnest({tokens('text')}) AS token FROM documents)
SELECT token, {dim('token')} AS dim, count(*)::BIGINT AS occurrences FROM t GROUP BY token""",
    "term_freq": f"WITH {index_ctes().lstrip()} SELECT doc_id, dim, tf FROM tf",
    "doc_freq": f"WITH {index_ctes().lstrip()} SELECT dim, df FROM dfreq",
    "idf": f"WITH {index_ctes().lstrip()} SELECT dim, round(idf, 10) AS idf FROM idf",
    "tfidf_weights": f"WITH {index_ctes().lstrip()} SELECT doc_id, dim, round(w, 8) AS w FROM w",
    "doc_norms": f"""
WITH {index_ctes().lstrip()},
docs AS (SELECT doc_id FROM documents)
SELECT doc_id, round(coalesce(nm.dn, 1.0), 8) AS norm FROM docs LEFT JOIN nm USING (doc_id)""",
    "query_vector": f"""
WITH {BENCH_Q},{query_ctes('q')}
SELECT query_id, dim, qtf, round(qn, 8) AS qnorm FROM qtf JOIN qn USING (query_id)""",
    "search_topk": search_sql(
        "q AS (SELECT 0 AS query_id, 'the of and' AS query)", 10,
        "SELECT doc_id, rank, score FROM rk WHERE rank <= {k}"),
    "search_topk_batch": search_sql(
        BENCH_Q, 5, "SELECT query_id, doc_id, rank, score FROM rk WHERE rank <= {k}"),
    "search_request_validation": f"""
WITH {CONV_REQ}
SELECT query_id, top_k,
       CASE WHEN query IS NULL OR NOT regexp_matches(query, '\\S') THEN false
            WHEN top_k < 1 OR top_k > 100 THEN false ELSE true END AS accepted,
       CASE WHEN query IS NULL OR NOT regexp_matches(query, '\\S') THEN 'blank query'
            WHEN top_k < 1 THEN 'top_k below 1'
            WHEN top_k > 100 THEN 'top_k above 100' END AS reason
FROM req""",
    "search_conversation_batch": search_sql(
        CONV_SEARCH + ", q AS (SELECT query_id, query FROM req WHERE regexp_matches(query, '\\S') "
        "AND top_k BETWEEN 1 AND 100)", 0,
        "SELECT rk.query_id, doc_id, rank, score FROM rk JOIN req USING (query_id) "
        "WHERE rank <= req.top_k"),
    "search_rare_words": search_sql(
        "q AS (SELECT item_id AS query_id, concat_ws(' ', 'the of', "
        "list_max(list_transform(" + tokens("text") + ", lambda t: struct_pack(n := length(t), t := t))).t) "
        "AS query FROM benchmark)", 3,
        "SELECT query_id, doc_id, rank, score FROM rk WHERE rank <= {k}"),
    "search_repeated_ids": search_sql(
        BENCH_Q + ", greatest_text AS (SELECT doc_id // 2 AS doc_id, max(text) AS text "
        "FROM documents GROUP BY 1)", 5,
        "SELECT query_id, doc_id, rank, score FROM rk WHERE rank <= {k}", table="greatest_text"),
    "search_all_versions": search_sql(
        LATEST_CONV + ", q AS (SELECT 0 AS query_id, 'the and le la' AS query)", 10,
        """, top AS (SELECT * FROM rk WHERE rank <= {k}),
v AS (SELECT top.doc_id, top.score, c.turn AS version, c.role,
             row_number() OVER (ORDER BY top.score DESC, top.doc_id, c.turn) AS rank
      FROM top JOIN conversations c ON c.conv_id = top.doc_id)
SELECT doc_id AS conv_id, rank, score, version, role FROM v WHERE rank <= {k}""",
        table="latest", id_col="conv_id").replace(
        "n AS (SELECT count(*)::DOUBLE AS n FROM latest)",
        "n AS (SELECT count(*)::DOUBLE AS n FROM conversations)"),
    "search_latest_version": search_sql(
        LATEST_CONV + ", q AS (SELECT 0 AS query_id, 'the and le la' AS query)", 10,
        """SELECT rk.doc_id AS conv_id, rank, score, latest.role FROM rk
JOIN latest ON latest.conv_id = rk.doc_id WHERE rank <= {k}""",
        table="latest", id_col="conv_id"),
}

SEARCH_ORACLE["stream_index_refresh"] = SEARCH_ORACLE["tfidf_weights"]
SEARCH_ORACLE["search_batch_stored"] = SEARCH_ORACLE["search_topk_batch"]
