"""Document fingerprints by SpotSigs, in DataFrame functions only.

A signature is a common-word anchor with the chain of up to ``chain`` content words
that follow it before the next anchor; the start of a text is an anchor too.  In a text
without any common word (another language, code, lists) every word is an anchor, with
the ``chain`` words after it, so the signatures span the whole text.  A fingerprint is the sorted set of 32-bit signature
hashes; likeness is the Jaccard share of two sets.

``near_duplicates`` compares sets through partitions of set length: two sets can
only reach the threshold if the shorter has at least threshold times the longer's
length, and must share one of the rarest signatures of each (prefix filter), so
other pairs are pruned before any set is compared.

Defined cases: null text is empty text; a text without a word has the empty set and
fingerprint ``''``; two empty sets have likeness 1, an empty and a filled one 0;
repeated rows are rows of their own; null ids come after all others in
descending order; rows of equal id are ordered by text; one document is its own next;
very long texts are read whole; columns other than the id and the text, whatever their
names, are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.ranges import range_bounds, range_bucket

#: Common words of English, German, French and Spanish that serve as anchors.
ANCHORS = ("the of and to in is that it for with as on by at from this are was be or an a "
           "der die das und ist von den mit zu auf nicht ein eine im dem "
           "le la les et est du des un une en que qui dans pour par sur au "
           "el los las de y se por con no una su para del").split()
CHAIN = 2
BUCKET_ROWS = 2_000       # documents a window sorts together
MAX_BUCKETS = 10_000


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The set of signature hashes (sorted array of int) of a text column."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    anchor = "|".join(ANCHORS)
    pieces = F.split(F.concat(F.lit("^ "), words, F.lit(" ")), f" (?=(?:{anchor}) )")
    chains = F.transform(pieces, lambda p: F.substring_index(F.rtrim(p), " ", 1 + chain))
    kept = F.filter(chains, lambda p: F.instr(p, " ") > 0)
    # one array, shifted against itself: no lambda reads another array
    one = F.filter(F.split(words, " "), lambda w: w != "")
    every = one
    for k in range(1, chain + 1):
        every = F.zip_with(every, F.slice(one, F.lit(1 + k), F.greatest(F.size(one), F.lit(1))),
                           lambda a, b: F.concat_ws(" ", a, b))
    kept = F.when(F.concat(F.lit(" "), words, F.lit(" ")).rlike(f" (?:{anchor}) "), kept).otherwise(every)
    return F.array_sort(F.array_distinct(F.transform(kept, lambda p: F.hash(p))))


def as_string(sigs: Column) -> Column:
    """Eight lowercase hex digits per signature, in ascending order."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(
        s.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard share of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): the next document by descending id,
    after the last the first.

    Ids are cut into range buckets of literal bounds; the first row of every bucket is
    also put at the end of the bucket before it, so one window per bucket is enough."""
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = base.count()
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    bounds = range_bounds(base, "doc_id", buckets)
    low = base.where("doc_id is null").agg(F.min("text").alias("t")).first()["t"]
    # descending order: buckets len-1 .. 0, then -1 (null ids), then back to the top
    order = [*range(len(bounds) - 1, -1, -1)] + ([-1] if low is not None else [])
    if not order:
        order = [-1]
    before = {b: order[i - 1] for i, b in enumerate(order)}
    bucket = F.coalesce(range_bucket(F.col("doc_id"), bounds), F.lit(-1))
    rows = base.withColumn("bucket", bucket).withColumn("extra", F.lit(0))
    spark = docs.sparkSession
    heads = spark.createDataFrame([(int(v), before[i]) for i, v in enumerate(bounds)],
                                  "head long, bucket int")       # at most MAX_BUCKETS rows
    firsts = base.join(F.broadcast(heads), F.col("doc_id") == F.col("head")).select(
        "doc_id", "text", "bucket", F.lit(1).alias("extra"))
    if low is not None:
        firsts = firsts.unionByName(spark.createDataFrame(
            [(None, low, before[-1], 1)], "doc_id long, text string, bucket int, extra int"))
    one = Window.partitionBy("bucket").orderBy("extra", F.col("doc_id").desc_nulls_last(), "text")
    both = rows.unionByName(firsts).withColumn("sigs", signatures(F.col("text")))
    return (both.withColumn("next_text", F.lead("text").over(one))
            .withColumn("next_sigs", F.lead("sigs").over(one))
            .where("extra = 0").drop("extra", "bucket"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by as many first ones of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half),
                    F.substr(following, F.lit(1), half))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness >= threshold) of the smallest ids of distinct signature sets.

    Equal sets are one class, so copies are never paired with each other.  Sets are known
    by a hash of theirs: an id may hold several sets, and a set with null ids only has a
    null in its pairs.  Texts without a word are one class of their own, like no other."""
    sets = (docs.select(F.col(id_col).alias("doc_id"), signatures(F.coalesce(
        F.col(text_col), F.lit(""))).alias("sigs"))
        .where(F.size("sigs") > 0).groupBy("sigs").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("n", F.size("sigs")).withColumn("key", F.sha2(as_string(F.col("sigs")).cast("binary"), 256)))
    # length partitions: bounds grow by 1 / threshold, so partners are at most one apart
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9)
    df = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    ranked = (sets.select("key", "n", F.explode("sigs").alias("sig")).join(df, "sig")
              .withColumn("rank", F.row_number().over(
                  Window.partitionBy("key").orderBy("df", "sig"))))
    prefix = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    prefix = prefix.select("key", "n", "sig", part.alias("part"))
    probe = prefix.select(F.col("key").alias("kb"), F.col("n").alias("nb"), "sig",
                          F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    cand = (prefix.withColumnRenamed("key", "ka").join(probe, ["sig", "part"])
            .where((F.col("ka") != F.col("kb")) & (F.col("nb") >= F.col("n") * threshold - 1e-9)
                   & (F.col("n") >= F.col("nb") * threshold - 1e-9))
            .select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb")).distinct())
    own = sets.select("key", "doc_id", "sigs")
    by_id = F.array_sort(F.array("ia", "ib"))           # a null comes last
    return (cand.join(own.toDF("ka", "ia", "sa"), "ka").join(own.toDF("kb", "ib", "sb"), "kb")
            .withColumn("likeness", likeness(F.col("sa"), F.col("sb")))
            .where(F.col("likeness") >= threshold)
            .select(by_id[0].alias("a"), by_id[1].alias("b"), "likeness"))
