"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (decontam, langid, lmscore, mixing, piece_bpe, secret_scan, simhash,
                          spotsigs, suffix_dedup, toxicity, urlfilter, vector_codes, word_runs)
from tidemark.llm.common import held_out, load


def q_op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(load(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")


def q_op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def q_op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lmscore.score(load(spark, sf_dir, "documents"))
    return (scored.withColumn("log_score", F.round("log_score", 4))
            .withColumn("mean_log_score", F.round("mean_log_score", 6)))


def q_op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(load(spark, sf_dir, "pages"))


def q_op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = langid.train(docs, ~held_out(F.col("doc_id")))
    return (langid.predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def q_op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spotsigs.with_next(load(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited", spotsigs.edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sigs", "next_sigs",
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       spotsigs.signatures(F.col("edited")).alias("edited_sigs"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", spotsigs.as_string(F.col("sigs")).alias("fingerprint"),
        spotsigs.as_string(F.col("edited_sigs")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        spotsigs.likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def q_op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.find_leaks(docs, load(spark, sf_dir, "benchmark")).select(
        "doc_id", "contaminated", "items", "leaks")


def q_op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    count = {k: F.size(secret_scan.only(F.col("spans"), k)).cast("long").alias(f"n_{k}")
             for k in ("assign", "access", "hex")}
    base = secret_scan.listed(secret_scan.only(F.col("spans"), "assign", "access", "hex"))
    return found.select("doc_id", *count.values(),
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


def q_op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(load(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def q_op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def echoed(doc_id: Column, text: Column) -> Column:
    """Of every tenth text (by crc32 of the id) the words from one on repeat a stretch.

    Word i >= a becomes word a + (i - a) % p, where a and p follow from the hash; other
    texts stay.  A null id counts as empty text.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    edited = F.concat_ws(" ", F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), edited).otherwise(text)


def q_op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", echoed(F.col("doc_id"), F.col("text")).alias("text"))
    found = word_runs.find_runs(docs)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.expr("best.length * 1000 div best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def q_op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = piece_bpe.encode(load(spark, sf_dir, "documents"),
                             public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def q_op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, book = vector_codes.compress(load(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error",
                        F.lit(vector_codes.books_sha256(book)).alias("codebooks_sha256"))


QUERIES = {
    "op1_suffix_dedup": q_op1_suffix_dedup,
    "op2_mixing": q_op2_mixing,
    "op3_lm_scores": q_op3_lm_scores,
    "op4_urls": q_op4_urls,
    "op5_langid": q_op5_langid,
    "op6_spotsigs": q_op6_spotsigs,
    "op7_decontamination": q_op7_decontamination,
    "op8_secrets": q_op8_secrets,
    "op9_simhash": q_op9_simhash,
    "op10_toxicity": q_op10_toxicity,
    "op11_word_runs": q_op11_word_runs,
    "op12_piece_bpe": q_op12_piece_bpe,
    "op13_vector_codes": q_op13_vector_codes,
}
