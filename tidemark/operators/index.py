"""Hashed TF-IDF index as ordinary tables.

Formula (fixed by the index format):

* tf(d, t)  = raw count of dimension t in document d
* df(t)     = number of documents containing dimension t
* N         = number of document rows (rows without a usable token count)
* idf(t)    = ln(1 + N / (1 + df(t)))
* w(d, t)   = tf * idf;  norm(d) = sqrt(sum w^2), a zero norm reads as 1.0

Plan shape, chosen for very large corpora:

* term frequencies are counted inside each document row
  (:func:`term_vectors`), so tokens are never shuffled;
* df is a partial aggregate over at most ``DIM`` keys per task, so its
  shuffle is tiny whatever the corpus size;
* the idf table has at most ``DIM`` (16,384) entries, a proven bound, so it
  is packed into one dense array and attached to every row as a scalar
  subquery; weights and the norm are then computed inside the row too;
* only the final postings ``(dim, doc_id, w, norm)`` are exploded.

So a full build has one tiny shuffle (df) and no shuffle of text or
postings.  :func:`write_index` materialises the term vectors once and
writes the postings bucketed by ``doc_id`` (so searches aggregate per
document without a shuffle) and sorted by ``(dim, doc_id)`` in each bucket
(so a query touching a few dimensions reads only the row groups whose
statistics cover them).
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import DIM, concat_text, term_vectors, vector_norm

NORM_CLASSES = 32


@dataclass
class TextIndex:
    """The tables of one index.  All lazily defined unless read from disk."""

    terms: DataFrame            # doc_id, terms array<struct<dim,tf>>
    doc_freq: DataFrame         # dim, df
    n_docs: DataFrame           # one row: n
    idf: DataFrame              # dim, idf
    postings: DataFrame         # dim, doc_id, w, norm
    docs: DataFrame             # doc_id, norm, payload columns
    payload: list[str] = field(default_factory=list)
    versions: DataFrame | None = None   # all-versions mode: id, version order, payload
    id_name: str = "doc_id"             # the source id column; results use this name
    payload_rows: DataFrame | None = None  # doc_id + payload only (joined to results)
    source: DataFrame | None = None     # latest-version rows, where ids may repeat
    vectors: DataFrame | None = None    # written with bounds: doc_id, norm, dims, ws by document
    dim_stats: DataFrame | None = None  # written with bounds: dim, cls, df, top unit weight
    bucketed: bool = False              # postings are read from buckets by doc_id


class RepeatedIds(ValueError):
    """Documents share an id and the build was told to refuse that."""


def _parallel_input(df: DataFrame, key: str) -> DataFrame:
    """Spread a small input (fewer partitions than cores) over the cores.

    Large inputs already have a partition per file split and are left
    alone: re-shuffling raw text would only add cost.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    if not files or len(files) >= cores:      # derived in memory, or already split
        return df
    if sum(_dir_bytes(spark, f) for f in files) < cores * (8 << 20):
        return df.repartition(cores, key)
    return df


def explode_terms(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row ``t`` per term of ``terms``.

    ``explode_outer`` + an explicit null filter, not ``explode``: for a
    plain explode the optimizer infers a ``size(terms) > 0`` filter and
    pushes it below the projections, re-inlining the whole tokenise/hash
    chain into it several times per row.
    """
    return (df.select(*keep, F.explode_outer("terms").alias("t"))
            .where(F.col("t").isNotNull()))


def corpus_size(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).cast("long").alias("n"))


def document_frequencies(terms: DataFrame) -> DataFrame:
    """``(dim, df)``: documents per dimension (at most DIM rows)."""
    return (explode_terms(terms.select("terms"), []).select("t.dim")
            .groupBy("dim").agg(F.count(F.lit(1)).cast("long").alias("df")))


def idf_table(doc_freq: DataFrame, n_docs: DataFrame) -> DataFrame:
    n = n_docs.select("n").scalar()
    return doc_freq.select(
        "dim", F.log(F.lit(1.0) + n.cast("double") / (F.lit(1.0) + F.col("df"))).alias("idf"))


def dense_idf(idf: DataFrame) -> Column:
    """Scalar subquery: ``array<double>`` of length DIM, idf at index dim+1.

    Bounded by DIM whatever the corpus size, so one row is safe.
    """
    spark = idf.sparkSession
    full = spark.range(DIM).select(F.col("id").cast("int").alias("dim")).join(
        F.broadcast(idf), "dim", "left")
    packed = full.agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "idf"))),
                                  lambda e: F.coalesce(e["idf"], F.lit(0.0))).alias("v"))
    return packed.select("v").scalar()


def weigh(terms: DataFrame, idf: DataFrame, keep: list[str]) -> DataFrame:
    """Add in-row weights ``w`` to each term and the document ``norm``."""
    vec = dense_idf(idf)
    staged = terms.select(*keep, "terms", vec.alias("_idf"))
    weighted = staged.select(*keep, F.transform(
        "terms", lambda e: F.struct(
            e["dim"].alias("dim"), e["tf"].alias("tf"),
            (e["tf"] * F.element_at(F.col("_idf"), e["dim"] + 1)).alias("w"))).alias("terms"))
    return weighted.select(*keep, "terms", vector_norm("terms", "w").alias("norm"))


def norm_class(norm: str) -> Column:
    """Documents of like norm: half a power of two apart, NORM_CLASSES at most.

    A unit weight is tf * idf / norm, so its greatest value in a class says much more of a
    long text than the greatest of all, which belongs to some text of one word.
    """
    return F.least(F.greatest(F.floor(2 * F.log2(F.greatest(F.col(norm), F.lit(1.0)))), F.lit(0)),
                   F.lit(NORM_CLASSES - 1)).cast("int")


def to_postings(weighted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return (explode_terms(weighted.select(F.col(id_col).alias("doc_id"), "norm", "terms"),
                          ["doc_id", "norm"])
            .select(F.col("t.dim").alias("dim"), "doc_id",
                    F.col("t.w").alias("w"), "norm"))


def build_index(docs: DataFrame, id_col: str = "doc_id",
                text_cols: tuple[str, ...] | list[str] = ("text",),
                payload_cols: tuple[str, ...] | list[str] = (),
                version_col: str | None = None,
                versions: str = "latest",
                spread: bool = True, repeated: str = "last") -> TextIndex:
    """Define the index over a documents DataFrame (lazy).

    ``versions``:
      * ``"latest"`` (default): when ``version_col`` is given, keep one row
        per id, the one with the greatest version (latest-version view);
      * ``"all"``: reproduce the in-memory service exactly: N counts every
        row, each id is indexed with its last version's text, and search
        lists every version row with its id's score.

    ``repeated`` says what ids that occur more than once mean without a version
    column: ``"last"`` (default) keeps the row whose text, then payload, is greatest
    (rows of a table have no order of their own; name a ``version_col`` to choose),
    ``"error"`` raises :class:`RepeatedIds`, ``"trusted"`` skips the check of the ids,
    one aggregate over the id column alone.  Null ids count as one id.
    """
    if repeated not in ("last", "error", "trusted"):
        raise ValueError(f"unknown way to treat repeated ids {repeated!r}")
    payload = list(payload_cols)
    src = docs.select(F.col(id_col).alias("doc_id"),
                      concat_text(*text_cols).alias("_text"),
                      *([F.col(version_col).alias("_ver")] if version_col else []),
                      *payload)
    version_rows = latest = None
    if version_col:
        from tidemark.operators.versions import latest_version
        latest = latest_version(src, "doc_id", ["_ver"])
        if versions == "all":
            version_rows = src.select("doc_id", "_ver", *payload)
            n_docs = corpus_size(src)
        else:
            n_docs = corpus_size(latest)
        src = latest
    else:
        if repeated != "trusted" and _repeats(docs, id_col):
            if repeated == "error":
                raise RepeatedIds(f"column {id_col!r} holds an id more than once")
            from tidemark.operators.versions import latest_version
            latest = src = latest_version(src, "doc_id", ["_text"])
        n_docs = corpus_size(src)
    if spread:
        src = _parallel_input(src, "doc_id")
    terms = term_vectors(src, "_text", ["doc_id"])
    idx = _assemble(terms, n_docs, src.select("doc_id", *payload), payload, version_rows)
    idx.id_name = id_col
    idx.source = latest
    return idx


def _repeats(docs: DataFrame, id_col: str) -> bool:
    return not docs.groupBy(id_col).count().where("count > 1").limit(1).isEmpty()


def _assemble(terms: DataFrame, n_docs: DataFrame, doc_rows: DataFrame,
              payload: list[str], version_rows: DataFrame | None,
              doc_freq: DataFrame | None = None) -> TextIndex:
    dfreq = document_frequencies(terms) if doc_freq is None else doc_freq
    idf = idf_table(dfreq, n_docs)
    weighted = weigh(terms, idf, ["doc_id"])
    postings = to_postings(weighted)
    if payload:
        docs = weighted.select("doc_id", "norm").join(doc_rows, "doc_id")
    else:
        docs = weighted.select("doc_id", "norm")
    return TextIndex(terms=terms, doc_freq=dfreq, n_docs=n_docs, idf=idf,
                     postings=postings, docs=docs, payload=payload,
                     versions=version_rows,
                     payload_rows=doc_rows.select("doc_id", *payload) if payload else None)


def _dir_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def _table_name(path: str) -> str:
    return "tidemark_postings_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def new_build() -> str:
    """Name of a new build; names sort by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, path: str, build: str) -> None:
    """Make ``build`` the current one: one small file, written after everything else."""
    spark.createDataFrame([(build,)], "build string").coalesce(1).write.json(
        f"{path}/published/{build}")


def current_build(spark: SparkSession, path: str) -> str:
    """Folder of the newest build whose publication is complete."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        raise FileNotFoundError(f"no published index under {path}")
    done = [s.getPath().getName() for s in fs.listStatus(root)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    if not done:
        raise FileNotFoundError(f"no published index under {path}")
    return f"{path}/build={max(done)}"


def expire_builds(spark: SparkSession, path: str, keep: int = 2,
                  older_than_ms: int = 24 * 3600 * 1000) -> list[str]:
    """Remove all but the newest ``keep`` published builds; returns the builds removed.

    Builds that were never published go too once they are ``older_than_ms`` old (a younger
    one may still be written).  Readers that opened a build that goes lose its files, so
    keep as many as there can be open.
    """
    if keep < 1:
        raise ValueError("keep one build at least")
    jvm, root = spark.sparkContext._jvm, path.rstrip("/")
    to_path = jvm.org.apache.hadoop.fs.Path
    fs = to_path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def listed(folder: str) -> dict[str, int]:
        p = to_path(folder)
        return {s.getPath().getName(): s.getModificationTime()
                for s in (fs.listStatus(p) if fs.exists(p) else [])}

    done = sorted(b for b in listed(f"{root}/published")
                  if fs.exists(to_path(f"{root}/published/{b}/_SUCCESS")))
    kept, now = set(done[-keep:]), int(jvm.java.lang.System.currentTimeMillis())
    gone = []
    for folder, changed in sorted(listed(root).items()):
        build = folder.removeprefix("build=")
        if not folder.startswith("build=") or build in kept or (
                build not in done and now - changed < older_than_ms):
            continue
        fs.delete(to_path(f"{root}/published/{build}"), True)      # first: no reader starts with it
        name = _table_name(f"{root}/{folder}")
        for table in (name, f"{name}_vectors"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        fs.delete(to_path(f"{root}/{folder}"), True)
        gone.append(build)
    return gone


def write_index(index: TextIndex, path: str, buckets: int | None = None,
                bucket_bytes: int = 4 * 1024 * 1024,
                row_group_bytes: int = 16 * 1024 * 1024, bounds: bool = False) -> TextIndex:
    """Materialise the index as a new build under ``path`` and return it read back.

    A build has its own folder and table name; readers follow the newest
    complete publication, so a build that fails part-way changes nothing and
    an index that is already open keeps its files.

    1. term vectors are written once (the expensive tokenise + hash pass);
    2. df is re-derived from that table (a tiny aggregate) and written;
    3. the per-document term arrays are hash-partitioned on ``doc_id``
       (a shuffle of the compact array form), weights are computed in-row
       and the postings are written as a table *bucketed* by ``doc_id`` and
       sorted by ``(dim, doc_id)``: one file per bucket, no further shuffle;
    4. with ``bounds``, the weighted arrays themselves are written with the same
       buckets, and the greatest unit weight of every dimension and norm class beside
       its df: with them a batch search can leave out documents that cannot reach a
       top k (``search(bounded=True)``).

    Bucketing lets every search sum scores per (query, doc) without an
    exchange (a document's postings are all in one bucket), and the sort
    keeps Parquet min/max statistics on ``dim`` narrow, so a
    ``dim IN (...)`` filter skips row groups of other dimensions.  The
    bucket count defaults to about ``bucket_bytes`` of term data per bucket
    (at least one per core): a task sorts the postings of one bucket and holds its
    (query, doc) sums, so small buckets keep its memory the same however large the
    corpus is.  Norms and payload are re-derived on read.
    """
    spark = index.terms.sparkSession
    root = path.rstrip("/")
    build = new_build()
    path = f"{root}/build={build}"
    terms_df, n_docs_df, payload_df = index.terms, index.n_docs, index.payload_rows
    if index.source is not None:
        # versioned build: materialise the latest-version view once (shared
        # checkpoint folder) instead of re-aggregating it for every table
        from tidemark.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(spark)
        src = index.source.checkpoint(eager=True)
        terms_df = term_vectors(_parallel_input(src, "doc_id"), "_text", ["doc_id"])
        payload_df = src.select("doc_id", *index.payload) if index.payload else None
        if index.versions is None:
            n_docs_df = corpus_size(src)
    terms_df.write.mode("overwrite").parquet(f"{path}/terms")
    n_docs_df.write.mode("overwrite").parquet(f"{path}/n_docs")
    if index.versions is not None:
        index.versions.write.mode("overwrite").parquet(f"{path}/versions")
    if index.payload:
        payload_df.write.mode("overwrite").parquet(f"{path}/payload")
    terms = spark.read.parquet(f"{path}/terms")
    n_docs = spark.read.parquet(f"{path}/n_docs")
    document_frequencies(terms).write.mode("overwrite").parquet(f"{path}/doc_freq")
    idf = idf_table(spark.read.parquet(f"{path}/doc_freq"), n_docs)
    cores = max(1, spark.sparkContext.defaultParallelism)
    n_buckets = buckets or max(cores, -(-_dir_bytes(spark, f"{path}/terms") // bucket_bytes))
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    weighted = weigh(terms.repartition(n_buckets, "doc_id"), idf, ["doc_id"])
    (to_postings(weighted)
     .write.mode("overwrite").option("parquet.block.size", row_group_bytes)
     .option("path", f"{path}/postings")
     .bucketBy(n_buckets, "doc_id").sortBy("dim", "doc_id")
     .saveAsTable(name))
    if bounds:
        vectors = f"{name}_vectors"
        spark.sql(f"DROP TABLE IF EXISTS {vectors}")
        (weighted.select("doc_id", "norm", F.col("terms.dim").alias("dims"), F.col("terms.w").alias("ws"))
         .write.mode("overwrite").option("path", f"{path}/vectors")
         .bucketBy(n_buckets, "doc_id").sortBy("doc_id").saveAsTable(vectors))
        (spark.table(name).groupBy("dim", norm_class("norm").alias("cls")).agg(
            F.count(F.lit(1)).alias("df"), F.max(F.col("w") / F.col("norm")).alias("top"))
         .write.mode("overwrite").parquet(f"{path}/dim_stats"))               # DIM x classes at most
    spark.createDataFrame([(n_buckets, name, index.id_name, bounds)],
                          "buckets int, table string, id_name string, bounds boolean").coalesce(1) \
        .write.mode("overwrite").json(f"{path}/meta")
    publish(spark, root, build)
    return read_index(spark, root, index.payload, index.versions is not None)


def _postings_table(spark: SparkSession, path: str) -> DataFrame:
    """The bucketed postings table, registered from its folder if needed."""
    meta = spark.read.json(f"{path}/meta").first()
    name, n_buckets = meta["table"], int(meta["buckets"])
    if not spark.catalog.tableExists(name):
        id_type = spark.read.parquet(f"{path}/postings").schema["doc_id"].dataType.simpleString()
        spark.sql(f"""CREATE TABLE {name} (dim INT, doc_id {id_type}, w DOUBLE, norm DOUBLE)
                      USING parquet CLUSTERED BY (doc_id) SORTED BY (dim, doc_id)
                      INTO {n_buckets} BUCKETS LOCATION '{path}/postings'""")
    return spark.table(name)


def _vectors_table(spark: SparkSession, path: str) -> DataFrame:
    """The bucketed table of weighted arrays, registered from its folder if needed."""
    meta = spark.read.json(f"{path}/meta").first()
    name = f"{meta['table']}_vectors"
    if not spark.catalog.tableExists(name):
        id_type = spark.read.parquet(f"{path}/vectors").schema["doc_id"].dataType.simpleString()
        spark.sql(f"""CREATE TABLE {name} (doc_id {id_type}, norm DOUBLE, dims ARRAY<INT>,
                      ws ARRAY<DOUBLE>) USING parquet CLUSTERED BY (doc_id) SORTED BY (doc_id)
                      INTO {int(meta["buckets"])} BUCKETS LOCATION '{path}/vectors'""")
    return spark.table(name)


def read_index(spark: SparkSession, path: str, payload: list[str] | None = None,
               has_versions: bool = False) -> TextIndex:
    path = current_build(spark, path.rstrip("/"))
    terms = spark.read.parquet(f"{path}/terms")
    n_docs = spark.read.parquet(f"{path}/n_docs")
    dfreq = spark.read.parquet(f"{path}/doc_freq")
    idf = idf_table(dfreq, n_docs)
    norms = weigh(terms, idf, ["doc_id"]).select("doc_id", "norm")
    payload = list(payload or [])
    payload_rows = spark.read.parquet(f"{path}/payload") if payload else None
    docs = norms.join(payload_rows, "doc_id") if payload else norms
    versions = spark.read.parquet(f"{path}/versions") if has_versions else None
    meta = spark.read.json(f"{path}/meta").first()
    bounds = "bounds" in meta and bool(meta["bounds"])
    return TextIndex(terms=terms, doc_freq=dfreq, n_docs=n_docs, idf=idf,
                     postings=_postings_table(spark, path),
                     docs=docs, payload=payload, versions=versions,
                     id_name=meta["id_name"] or "doc_id", payload_rows=payload_rows, bucketed=True,
                     vectors=_vectors_table(spark, path) if bounds else None,
                     dim_stats=spark.read.parquet(f"{path}/dim_stats") if bounds else None)
