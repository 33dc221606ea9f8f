"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every query reads the driver's tables (or data Spark derives from them)
in full.  Doubles that come out of sums are rounded to 8 places so the
oracle comparison does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import token_dim, tokenize
from tidemark.operators.index import build_index, explode_terms, write_index
from tidemark.operators.search import query_vectors, search, search_one, validate_requests
from tidemark.session import scratch_path

SEARCH_QUERY = "the of and"
SEARCH_TOP_K = 10
BATCH_TOP_K = 5
VERSION_QUERY = "the and le la"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_index(spark: SparkSession, sf_dir: str):
    return build_index(load(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- text / index

def q_tokens(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    t = docs.select("doc_id", tokenize("text").alias("toks"))
    return t.select("doc_id", F.size("toks").cast("long").alias("n_tokens"),
                    F.array_join("toks", " ").alias("tokens"))


def q_token_dims(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    toks = docs.select(F.explode_outer(tokenize("text")).alias("token")).where(
        F.col("token").isNotNull())
    vocab = toks.groupBy("token").agg(F.count(F.lit(1)).cast("long").alias("occurrences"))
    return vocab.select("token", token_dim("token").alias("dim"), "occurrences")


def q_term_freq(spark, sf_dir):
    idx = documents_index(spark, sf_dir)
    return explode_terms(idx.terms, ["doc_id"]).select(
        "doc_id", F.col("t.dim").alias("dim"), F.col("t.tf").alias("tf"))


def q_doc_freq(spark, sf_dir):
    return documents_index(spark, sf_dir).doc_freq


def q_idf(spark, sf_dir):
    idx = documents_index(spark, sf_dir)
    return idx.idf.select("dim", F.round("idf", 10).alias("idf"))


def q_tfidf_weights(spark, sf_dir):
    idx = documents_index(spark, sf_dir)
    return idx.postings.select("doc_id", "dim", F.round("w", 8).alias("w"))


def q_doc_norms(spark, sf_dir):
    idx = documents_index(spark, sf_dir)
    return idx.docs.select("doc_id", F.round("norm", 8).alias("norm"))


def benchmark_queries(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def q_query_vector(spark, sf_dir):
    qv = query_vectors(benchmark_queries(spark, sf_dir))
    return qv.select("query_id", "dim", "qtf", F.round("qnorm", 8).alias("qnorm"))


def q_search_topk(spark, sf_dir):
    return search_one(spark, documents_index(spark, sf_dir), SEARCH_QUERY, SEARCH_TOP_K)


def q_search_topk_batch(spark, sf_dir):
    return search(documents_index(spark, sf_dir), benchmark_queries(spark, sf_dir),
                  k_col=None)


def q_search_batch_stored(spark, sf_dir):
    """The batch search over the written index (postings bucketed by doc_id)."""
    idx = write_index(documents_index(spark, sf_dir), scratch_path(spark, "stored-index"))
    return search(idx, benchmark_queries(spark, sf_dir), k_col=None)


def conversation_requests(spark, sf_dir) -> DataFrame:
    """User turns as search requests; ``top_k`` is the turn number."""
    conv = load(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
                       F.col("text").alias("query"), F.col("turn").cast("int").alias("top_k"))


def conversation_searches(spark, sf_dir) -> DataFrame:
    """Every user turn as a search; later turns ask for more results (1 to 100)."""
    return conversation_requests(spark, sf_dir).withColumn(
        "top_k", F.least(F.col("top_k") + 1, F.lit(100)))


def q_search_request_validation(spark, sf_dir):
    v = validate_requests(conversation_requests(spark, sf_dir))
    return v.select("query_id", "top_k", "accepted", "reason")


def q_search_conversation_batch(spark, sf_dir):
    """Every user turn against documents, each with its own top_k."""
    return search(documents_index(spark, sf_dir), conversation_searches(spark, sf_dir))


def rare_word_requests(spark, sf_dir) -> DataFrame:
    """The longest token of every benchmark item, asked for beside common words."""
    items = load(spark, sf_dir, "benchmark")
    longest = F.array_max(F.transform(tokenize("text"), lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))
    return items.select(F.col("item_id").alias("query_id"), F.concat_ws(
        " ", F.lit("the of"), longest["t"]).alias("query"))


def q_search_rare_words(spark, sf_dir):
    """Rare and common words together on the written index: few documents need scoring."""
    idx = write_index(documents_index(spark, sf_dir), scratch_path(spark, "rare-index"), bounds=True)
    return search(idx, rare_word_requests(spark, sf_dir), k_col=None, default_k=3, bounded=True)


def q_search_repeated_ids(spark, sf_dir):
    """Two documents under every id: the greater text of an id is indexed."""
    docs = load(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 2).alias("doc_id"), "text")
    return search(build_index(docs), benchmark_queries(spark, sf_dir), k_col=None)


def _versioned_conversations(spark, sf_dir, versions: str):
    conv = load(spark, sf_dir, "conversations")
    return build_index(conv, id_col="conv_id", text_cols=["text"], payload_cols=["role"],
                       version_col="turn", versions=versions)


def q_search_all_versions(spark, sf_dir):
    """Conversations as a versioned lake: turn = version.  N counts every
    turn, each conversation is indexed by its last turn, and every turn of
    a hit is listed with that score (the in-memory service's behaviour)."""
    idx = _versioned_conversations(spark, sf_dir, "all")
    return search_one(spark, idx, VERSION_QUERY, SEARCH_TOP_K)


def q_search_latest_version(spark, sf_dir):
    idx = _versioned_conversations(spark, sf_dir, "latest")
    return search_one(spark, idx, VERSION_QUERY, SEARCH_TOP_K)


SEARCH_QUERIES = {
    "tokens": q_tokens,
    "token_dims": q_token_dims,
    "term_freq": q_term_freq,
    "doc_freq": q_doc_freq,
    "idf": q_idf,
    "tfidf_weights": q_tfidf_weights,
    "doc_norms": q_doc_norms,
    "query_vector": q_query_vector,
    "search_topk": q_search_topk,
    "search_topk_batch": q_search_topk_batch,
    "search_batch_stored": q_search_batch_stored,
    "search_request_validation": q_search_request_validation,
    "search_conversation_batch": q_search_conversation_batch,
    "search_rare_words": q_search_rare_words,
    "search_repeated_ids": q_search_repeated_ids,
    "search_all_versions": q_search_all_versions,
    "search_latest_version": q_search_latest_version,
}
