"""Corpus pipeline: language ID, near-dedup, decontamination, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and returns documents; all but the last
return exactly the columns they got.  ``run`` writes each stage as Parquet in the
shared folder and reads it back, so a lost executor never reaches past one stage.

Defined cases, beside those of the operators: a null or empty text has no language and
goes in the first stage; the other stages keep such a row if they are given it (copies of
it are one component).  A null language or source is a value like any other; a null id
counts as empty text where ids are hashed.  Repeated rows are copies, of which the second
stage keeps one.  Texts of any length are read whole.  Further columns are carried along; the
last stage replaces ones named copy or shuffle_key.  Ties: of a component the smallest id
stays, then the smaller text.  An empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, mixing, secret_scan, simhash
from tidemark.llm.common import held_out, load
from tidemark.session import scratch_path

MIN_LANGUAGE_SCORE = 0.4    # calibrated; below it a document has no clear language


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a clear language go."""
    model = langid.train(docs, ~held_out(F.col("doc_id")))
    judged = langid.predict(docs.withColumn("__text", F.col("text")), model, "__text")
    return (judged.where((F.col("lang_pred") != langid.UNKNOWN)
                         & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (four words, four bits)."""
    return simhash.deduplicate(docs, shingle_words=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = decontam.find_leaks(docs, load(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    found = secret_scan.scan(docs)
    return (found.withColumn("text", secret_scan.redact(F.col("text"), F.col("spans")))
            .withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long"))
                        .otherwise(F.col("n_chars"))).select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poisson copies of every document towards the sources' target weights."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
]

#: Language ID is a trained model and components are iterative: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = load(spark, sf_dir, "documents"), scratch_path(spark, "corpus-pipeline")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
