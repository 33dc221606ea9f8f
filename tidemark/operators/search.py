"""Cosine top-k search over a :class:`TextIndex`.

Query side is the raw term-frequency vector (no idf), document side tf*idf,
both L2-normalised.  Results are ranked on the score rounded to 8 places
(descending), then id ascending, so the order does not depend on the
summation order of a distributed plan.

Plan: a batch over term vectors is multiplied in cells of bounded size
(:mod:`tidemark.operators.blocks`).  On a written index, whose postings are in
small buckets by document, a batch of few queries is exploded to ``(query_id,
dim, qtf)`` and joined with the postings; that side is broadcast only behind a
row-count check (else a shuffle join, where AQE splits hot dimensions), and
matches are summed per (query, doc) inside a bucket.  Per-query top-k is a ``row_number() <= K`` window, which Spark turns into a
partial group limit before the shuffle, so a query matching every document
ships at most K rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import term_vectors, vector_norm
from tidemark.operators.blocks import SCORE_SCALE, best_pairs
from tidemark.operators.index import NORM_CLASSES, TextIndex, explode_terms, norm_class
from tidemark.session import ensure_checkpoint_dir

MAX_TOP_K = 100
DEFAULT_TOP_K = 5
# Query-dimension rows up to which the query side is broadcast (~24 bytes each).
BROADCAST_QUERY_ROWS = 2_000_000
# Queries up to which a batch joins the bucketed postings of a written index.
BUCKET_QUERIES = 1000
# A single query's dimensions become a literal IN filter up to this many
# (a pathological query text is still answered exactly, by the join alone).
MAX_LITERAL_DIMS = 1000
SLACK = 4e-8                       # more than rounding can move two scores against each other
SEED_DOCS = 10                     # seeds hold about so many times k documents
SEED_CELL = 20                     # a seed cell holds at most so many times that
REST_SHARE = 0.5                   # of the floor that the cells left out may add up to
MAX_ESSENTIAL = 0.05               # of a query's postings that are read before all are


def _rank():
    """Output rank as bigint (the window's int rank stays for the limit filter)."""
    return F.col("rank").cast("long").alias("rank")


def query_vectors(queries: DataFrame, query_col: str = "query",
                  id_col: str = "query_id") -> DataFrame:
    """``(query_id, dim, qtf, qnorm)`` for each query (raw TF, no idf)."""
    tv = term_vectors(queries, query_col, [id_col])
    tv = tv.select(id_col, "terms", vector_norm("terms", "tf").alias("qnorm"))
    return (explode_terms(tv, [id_col, "qnorm"])
            .select(id_col, F.col("t.dim").alias("dim"), F.col("t.tf").alias("qtf"), "qnorm"))


def validate_requests(requests: DataFrame, query_col: str = "query",
                      k_col: str = "top_k") -> DataFrame:
    """Add ``accepted`` and ``reason``: blank query or top_k outside 1..100."""
    q = F.col(query_col)
    k = F.coalesce(F.col(k_col), F.lit(DEFAULT_TOP_K)) if k_col in requests.columns \
        else F.lit(DEFAULT_TOP_K)
    reason = (F.when(q.isNull() | ~q.rlike(r"(?U)\S"), F.lit("blank query"))
              .when(k < 1, F.lit("top_k below 1"))
              .when(k > MAX_TOP_K, F.lit(f"top_k above {MAX_TOP_K}")))
    return requests.withColumn(k_col, k.cast("int")).withColumn(
        "accepted", reason.isNull()).withColumn("reason", reason)


def _unit_norm():
    """A zero norm reads as 1."""
    return F.coalesce(F.nullif(F.col("norm"), F.lit(0.0)), F.lit(1.0))


def _unit_postings(postings: DataFrame) -> DataFrame:
    """Postings with the weight of the normalised document."""
    return postings.select("dim", "doc_id", (F.col("w") / _unit_norm()).alias("w"))


def _unit_query(qv: DataFrame, id_col: str) -> DataFrame:
    return qv.select(id_col, "dim", (F.col("qtf") / F.col("qnorm")).alias("qw"))


def _scores(matches: DataFrame, id_col: str) -> DataFrame:
    """Both sides come normalised, so a pair's state in the aggregate is one sum.

    Rounded to 8 places in double arithmetic (scores are in 0..1, and dividing the
    whole number gives the nearest double): ``round`` goes through a decimal object
    per pair."""
    dot = F.sum(F.col("qw") * F.col("w"))
    return matches.groupBy(id_col, "doc_id").agg(
        _rounded(dot).alias("score"))


def _rounded(dot):
    return F.floor(dot * SCORE_SCALE + 0.5) / SCORE_SCALE


def query_rows(requests: DataFrame, query_col: str, id_col: str) -> DataFrame:
    """``(id, _k, dim, qw)``: the unit vectors of the requests."""
    qv = query_vectors(requests.select(id_col, query_col), query_col, id_col)
    return qv.join(requests.select(id_col, "_k"), id_col).select(
        id_col, "_k", "dim", (F.col("qtf") / F.col("qnorm")).alias("qw"))


def _small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if 0 < rows <= limit else df


def _complete(index: TextIndex, pairs: DataFrame, vectors: DataFrame, id_col: str,
              small: bool) -> DataFrame:
    """Exact dot products of (query, document) pairs from the documents' own vectors.

    ``vectors`` has one row for each query: ``_q`` its (dim, qw).  Candidates that come
    from the bucketed postings meet the vectors bucket by bucket, without an exchange.
    """
    # an array lookup in every step: the query's dimensions are few, the document's are read once
    dot = F.aggregate("_q", F.lit(0.0).cast("double"), lambda s, e: s + e["qw"] * F.coalesce(
        F.try_element_at("ws", F.nullif(F.array_position("dims", e["dim"]), F.lit(0)).cast("int")),
        F.lit(0.0)))
    return (pairs.join(index.vectors, "doc_id")
            .join(F.broadcast(vectors) if small else vectors, id_col)
            .select(id_col, "doc_id", (dot / _unit_norm()).alias("dot")))


def bounded_pairs(index: TextIndex, rows: DataFrame, n_rows: int, n_queries: int, id_col: str,
                  limit: int) -> tuple[DataFrame, DataFrame] | None:
    """(query ids, pairs to be scored) of the queries that bounds serve; None if there are none.

    A cell is a dimension within a class of documents of like norm; ``ub`` is what it can
    add to a score of the query at most.

    1. A query's cells of greatest bound, until they hold ``SEED_DOCS`` times k documents,
       give partial scores; the k best documents of these are completed.  The least of
       their k exact scores is a floor: the k-th best score is not below it.  Cells of very
       many documents are no seeds (a group of copies would be read for every query).
    2. In every class, cells are left out from the least bound on while their bounds add up to
       less than ``REST_SHARE`` of the floor: a document that holds no other dimension cannot
       reach the top k, so only the other (essential) cells are joined with the postings.
    3. A pair stays if its partial score and the bounds left out can reach the floor.

    Weights are not negative, so every bound holds exactly; ``SLACK`` covers the rounding of
    scores, ties included.  Not served are queries with fewer than k seeds, which have no
    floor, and those whose essential cells hold more than ``MAX_ESSENTIAL`` of their postings
    (long texts of common words): adding up all of them costs less than completing many pairs.
    """
    stats = index.dim_stats                               # DIM x classes at most
    bounds = rows.join(F.broadcast(stats), "dim").withColumn("ub", F.col("qw") * F.col("top"))
    small_rows = 0 < n_rows * NORM_CLASSES <= limit
    small = 0 < n_queries * max(MAX_TOP_K, NORM_CLASSES) <= limit

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    unit = index.postings.withColumn("cls", norm_class("norm"))

    def partial(cells: DataFrame) -> DataFrame:
        cells = cells.select(id_col, "dim", "cls", "qw")
        met = unit.join(F.broadcast(cells) if small_rows else cells, ["dim", "cls"])
        return met.groupBy(id_col, "doc_id").agg(
            F.sum(F.col("qw") * F.col("w") / _unit_norm()).alias("part"), F.first("cls").alias("cls"))

    best = Window.partitionBy(id_col).orderBy(F.col("ub").desc(), "dim", "cls")
    earlier = F.coalesce(F.sum("df").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    few = bounds.where(F.col("df") <= F.col("_k") * SEED_DOCS * SEED_CELL)
    seeds = few.withColumn("_df", earlier).where(F.col("_df") < F.col("_k") * SEED_DOCS)
    ks = rows.select(id_col, "_k").distinct()
    order = Window.partitionBy(id_col).orderBy(F.col("part").desc(), "doc_id")
    first = (partial(seeds).withColumn("_rn", F.row_number().over(order))
             .where(F.col("_rn") <= MAX_TOP_K).join(near(ks), id_col)
             .where(F.col("_rn") <= F.col("_k")).select(id_col, "doc_id"))
    floors = (_complete(index, near(first), query_arrays(rows, id_col), id_col, small_rows)
              .groupBy(id_col).agg(F.min("dot").alias("_floor"), F.count(F.lit(1)).alias("_n"))
              .join(near(ks), id_col).where(F.col("_n") == F.col("_k"))
              .select(id_col, (F.col("_floor") - SLACK).alias("_floor")))
    least = Window.partitionBy(id_col, "cls").orderBy("ub", "dim")
    cells = (bounds.join(near(floors), id_col).withColumn("_cum", F.sum("ub").over(least))
             .withColumn("_essential", F.col("_cum") >= F.col("_floor") * REST_SHARE).checkpoint())
    served = (cells.groupBy(id_col).agg(
        F.sum(F.when(F.col("_essential"), F.col("df")).otherwise(F.lit(0))).alias("_some"),
        F.sum("df").alias("_all")).where(F.col("_some") <= F.col("_all") * MAX_ESSENTIAL)
        .select(id_col).checkpoint())
    if served.isEmpty():
        return None
    cells = cells.join(near(served), id_col, "left_semi")
    rest = cells.groupBy(id_col, "cls").agg(
        F.max("_floor").alias("_floor"),
        F.coalesce(F.max(F.when(~F.col("_essential"), F.col("_cum"))), F.lit(0.0)).alias("_rest"))
    found = partial(cells.where("_essential")).join(near(rest), [id_col, "cls"]).where(
        F.col("part") + F.col("_rest") >= F.col("_floor"))
    return served, found.select(id_col, "doc_id")


def query_arrays(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.groupBy(id_col).agg(F.collect_list(F.struct("dim", "qw")).alias("_q"))


def _bounded_scores(index: TextIndex, requests: DataFrame, query_col: str, id_col: str,
                    limit: int) -> DataFrame:
    """(id, doc_id, score) of every pair that can be among a query's top k, exactly."""
    ensure_checkpoint_dir(requests.sparkSession)
    rows = query_rows(requests, query_col, id_col).checkpoint()
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("q")).first()
    found = bounded_pairs(index, rows, size["n"], size["q"], id_col, limit)
    if found is None:
        return _all_scores(index, rows, size["n"], id_col, limit)
    served, pairs = found
    done = _complete(index, pairs, query_arrays(rows.join(served, id_col, "left_semi"), id_col), id_col,
                     0 < size["n"] <= limit)
    others = rows.join(served, id_col, "left_anti")
    return done.select(id_col, "doc_id", _rounded(F.col("dot")).alias("score")).unionByName(
        _all_scores(index, others, size["n"], id_col, limit))


def _all_scores(index: TextIndex, rows: DataFrame, n_rows: int, id_col: str, limit: int) -> DataFrame:
    """Every pair that shares a dimension."""
    return _scores(_unit_postings(index.postings).join(
        _small(rows.select(id_col, "dim", "qw"), n_rows, limit), "dim"), id_col)


def search(index: TextIndex, queries: DataFrame, query_col: str = "query",
           id_col: str = "query_id", k_col: str | None = "top_k",
           broadcast_rows: int | None = None, default_k: int = DEFAULT_TOP_K,
           bounded: bool = False) -> DataFrame:
    """Top-k documents for every query in a table.

    ``k_col`` names a per-request top_k column; without one every query
    gets ``default_k`` results.

    Output: ``query_id, <id>, rank, score`` (+ the index payload columns),
    ``<id>`` being the id column the index was built on.
    Rejected requests (blank, top_k outside 1..100) produce no rows; use
    :func:`validate_requests` to see why.

    ``broadcast_rows`` asks for the join with the postings, the query side broadcast up to
    so many rows; without it the size of the batch and the index decide.

    ``bounded`` (indexes written with ``bounds`` only): leave out documents that
    cannot reach a query's top k, see :func:`bounded_pairs`; the results are the same.  It
    pays for short queries whose rare words decide; not the default, since raw counts let
    common words rule the scores of long texts.  Query ids are taken to be distinct.
    """
    if not (1 <= int(default_k) <= MAX_TOP_K):
        raise ValueError(f"top_k must be in 1..{MAX_TOP_K}")
    if bounded and index.vectors is None:
        raise ValueError("this index stores no bounds: write_index(bounds=True) first")
    if k_col and k_col in queries.columns:
        req = validate_requests(queries, query_col, k_col).where("accepted").withColumn(
            "_k", F.col(k_col))
    else:
        req = queries.withColumn("_k", F.lit(int(default_k)))
    # one small job sizes both sides: the requests and their dimensions
    sized = term_vectors(req.select(id_col, query_col), query_col, [id_col]).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("dims")).first()
    n_queries = sized["n"]
    # ranked results are at most MAX_TOP_K rows per query: a checked bound
    small_results = n_queries * MAX_TOP_K <= BROADCAST_QUERY_ROWS
    limit = BROADCAST_QUERY_ROWS if broadcast_rows is None else broadcast_rows
    if bounded:
        scores = _bounded_scores(index, req, query_col, id_col, limit)
    elif broadcast_rows is None and (not index.bucketed or n_queries > BUCKET_QUERIES):
        scores = best_pairs(index, req, query_col, id_col, n_queries, sized["dims"])
    else:
        qv = _unit_query(query_vectors(req.select(id_col, query_col), query_col, id_col), id_col)
        scores = _all_scores(index, qv, sized["dims"], id_col, limit)
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("doc_id").asc())
    ranked = scores.withColumn("rank", F.row_number().over(w)).where(
        F.col("rank") <= MAX_TOP_K)
    ks = req.select(id_col, "_k")
    ranked = ranked.join(F.broadcast(ks) if n_queries <= BROADCAST_QUERY_ROWS else ks, id_col).where(
        F.col("rank") <= F.col("_k"))
    return _attach_payload(index, ranked, id_col, small_results)


def _attach_payload(index: TextIndex, ranked: DataFrame, id_col: str,
                    small: bool) -> DataFrame:
    """``ranked`` carries ``_k``, the requested top_k of its query.

    When ``small`` (results bounded by queries x 100 under the broadcast
    limit) the results are broadcast, so the large documents / versions
    table is only scanned, never shuffled.
    """
    side = F.broadcast(ranked) if small else ranked
    if index.versions is not None:
        return _expand_versions(index, side, id_col)
    out_id = F.col("doc_id").alias(index.id_name)
    if not index.payload:
        return ranked.select(id_col, out_id, _rank(), "score")
    # the payload table only: no weights or norms are recomputed for a lookup
    docs = index.payload_rows if index.payload_rows is not None else \
        index.docs.select("doc_id", *index.payload)
    return docs.join(side, "doc_id").select(id_col, out_id, _rank(), "score", *index.payload)


def _expand_versions(index: TextIndex, ranked: DataFrame, id_col: str) -> DataFrame:
    """All-versions mode: every stored version of a hit is a result row.

    The top-k rows come from the top-k ids (each id has >= 1 row), so the
    versions are joined to the already-limited hits, then re-ranked on
    (score desc, id asc, version asc) and cut to k again.
    """
    v = index.versions
    hits = v.join(ranked, "doc_id")
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("doc_id").asc(),
                                           F.col("_ver").asc())
    out = hits.drop("rank").withColumn("rank", F.row_number().over(w)).where(
        F.col("rank") <= F.col("_k"))
    return out.select(id_col, F.col("doc_id").alias(index.id_name), _rank(), "score",
                      F.col("_ver").alias("version"), *index.payload)


def search_one(spark: SparkSession, index: TextIndex, query: str,
               top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """Top-k for one query string: ``<id>, rank, score`` (+ payload).

    Raises ``ValueError`` for a blank query or top_k outside 1..100.  The
    query's dimensions are few (bounded by the query text), so they are
    turned into a literal ``dim IN (...)`` filter that reaches the
    postings scan; on a written index only files covering them are read.
    """
    if query is None or not query.strip():
        raise ValueError("query must not be blank")
    if not (1 <= int(top_k) <= MAX_TOP_K):
        raise ValueError(f"top_k must be in 1..{MAX_TOP_K}")
    q = spark.createDataFrame([(0, query)], "query_id int, query string")
    # one query's vector is bounded by its text: collect it once and ship
    # it as a local relation (no second tokenising job for the broadcast)
    rows = query_vectors(q).collect()
    if not rows:
        return _empty_result(spark, index)
    qv = spark.createDataFrame(rows, "query_id int, dim int, qtf double, qnorm double")
    dims = [r["dim"] for r in rows]
    postings = index.postings
    if len(dims) <= MAX_LITERAL_DIMS:
        postings = postings.where(F.col("dim").isin(dims))
    matches = _unit_postings(postings).join(F.broadcast(_unit_query(qv, "query_id")), "dim")
    scores = _scores(matches, "query_id")
    top = scores.orderBy(F.col("score").desc(), F.col("doc_id").asc()).limit(int(top_k))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    top = top.withColumn("rank", F.row_number().over(w)).withColumn("_k", F.lit(int(top_k)))
    out = _attach_payload(index, top, "query_id", True)
    return out.drop("query_id").orderBy("rank")


def _empty_result(spark: SparkSession, index: TextIndex) -> DataFrame:
    """No rows, with the column types of a non-empty result."""
    rows = index.payload_rows if index.payload_rows is not None else index.docs
    if index.versions is not None:
        rows = index.versions
    cols = [F.col("doc_id").alias(index.id_name), F.lit(0).cast("long").alias("rank"),
            F.lit(0.0).alias("score")]
    if index.versions is not None:
        cols.append(F.col("_ver").alias("version"))
    return rows.select(*cols, *index.payload).limit(0)
