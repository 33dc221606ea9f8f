"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprint: majority bits over XXH64 (seed 42) of the word shingles.
Search: the 64 bits are cut into parts of correlated bits, every part gets
its own threshold (dynamic programme over estimated candidate counts), each
fingerprint is probed under all keys within its part's threshold, and
candidates are verified on all 64 bits.  If thresholds t_i sum to
``max_bits - parts + 1``, a pair within ``max_bits`` agrees within t_i on some
part i, so nothing is lost whatever the estimates say.

Documents are collapsed to distinct fingerprints first; keys are hashed to
buckets, and a bucket returns a spanning forest of its links, never all pairs;
components are joined in Spark.  Buckets are counted first: one that holds more
than its share (a key that many fingerprints have in common) is cut into a square
of cells, in which every probe meets every entry once, so no task gets more than
about ``bucket_rows`` of each however many share a key.

Defined cases: null and word-less texts have fingerprint zero and link like
any other; fewer words than a shingle give one shingle of all of them;
repeated rows (also of one id) are rows of their own with equal results; a null
id never becomes a component id unless its whole component has none; an empty
table gives an empty result.  Extra columns are carried by ``deduplicate`` and
ignored by ``components``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.bytescan import mix64
from tidemark.llm.common import (ball, connected_components, local_components, materialise,
                                 pack, shuffle_partitions, text_udf)

BITS = 64
SEED = 42
CHUNK = 1 << 16        # shingles or pairs handled at once
PAIR_CHUNK = 1 << 20
PLAN_SAMPLE = 4096     # fingerprints looked at to plan the parts (never to search)
MAX_RADIUS = 3         # largest threshold of one part that is planned


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """SimHash of one text as a signed 64-bit number."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        h = xxhash.xxh64_intdigest(line, SEED)
        return h - (1 << 64) if h >> 63 else h
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start, end = (end - size)[:len(words) - shingle_words + 1], end[shingle_words - 1:]
    hash_of, n, ones = xxhash.xxh64_intdigest, len(start), np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(start[at:at + CHUNK].tolist(), end[at:at + CHUNK].tolist(), strict=True)
        h = np.fromiter((hash_of(line[a:b], SEED) for a, b in spans), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle_words: int = 4,
                     out: str = "fp") -> DataFrame:
    fn = text_udf(lambda t: fingerprint(t, shingle_words), "long")
    return docs.withColumn(out, fn(F.col(text_col)))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------------------ planning

@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    radius: int          # -1: the part is not probed


def correlated_parts(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Cut the bits into ``parts`` groups, most correlated bits together."""
    x = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    x -= x.mean(axis=0)
    scale = np.sqrt((x * x).sum(axis=0))
    scale[scale == 0] = 1.0
    corr = np.abs((x / scale).T @ (x / scale))
    np.fill_diagonal(corr, 0.0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        grown = [left[int(np.argmax(corr[np.ix_(left, left)].sum(axis=1)))]]
        left.remove(grown[0])
        while len(grown) < width:
            best = left[int(np.argmax(corr[np.ix_(left, grown)].sum(axis=1)))]
            grown.append(best)
            left.remove(best)
        groups.append(tuple(sorted(grown)))
    return groups


def part_keys(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    key = np.zeros(len(fps), dtype=np.int64)
    for j, b in enumerate(bits):
        key |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << j
    return key


def _pair_share(sample: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """Estimated share of pairs within r bits on the part, r = 0..MAX_RADIUS.

    The larger of the sample's own share and that of independent bits."""
    one = ((sample[:, None] >> np.array(bits, dtype=np.uint64)) & np.uint64(1)).mean(axis=0)
    dist = np.array([1.0])
    for q in 2 * one * (1 - one):
        dist = np.convolve(dist, [1 - q, q])
    model = np.cumsum(np.pad(dist, (0, MAX_RADIUS))[:MAX_RADIUS + 1])
    key = part_keys(sample, bits)[:1024]
    apart = np.bitwise_count(key[:, None] ^ key[None, :])[np.triu_indices(len(key), 1)]
    seen = np.array([(apart <= r).mean() if len(apart) else 0 for r in range(MAX_RADIUS + 1)])
    return np.maximum(model, seen)


def plan_parts(sample: np.ndarray, n: int, max_bits: int) -> list[Part]:
    """Parts and thresholds of the lowest estimated cost for n fingerprints."""
    best: tuple[float, list[Part]] | None = None
    if len(sample) == 0:
        sample = np.zeros(1, dtype=np.uint64)
    for m in range(1, max_bits + 2):
        groups, total = correlated_parts(sample, m), max_bits - m + 1
        # state: sum of thresholds so far -> (cost, thresholds)
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for bits in groups:
            share, nxt = _pair_share(sample, bits), {}
            for spent, (cost, got) in table.items():
                for r in range(-1, min(MAX_RADIUS, max_bits) + 1):
                    size = sum(_choose(len(bits), k) for k in range(r + 1))
                    here = cost + (0 if r < 0 else 10.0 * n * (1 + size) + n * n * share[r] / 2)
                    if spent + r not in nxt or here < nxt[spent + r][0]:
                        nxt[spent + r] = (here, got + (r,))
            table = nxt
        if total in table and (best is None or table[total][0] < best[0]):
            best = table[total][0], [Part(b, r) for b, r in zip(groups, table[total][1], strict=True)]
    if best is None:
        raise ValueError(f"no plan for {max_bits} bits")
    return best[1]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


# ------------------------------------------------------------------ search

def _probes(batch: pa.RecordBatch, parts: list[Part], balls: list[np.ndarray], buckets: int):
    """Runs of (bucket, key, fingerprint, probe flag): every fingerprint as an entry under
    its own keys and as a probe under all keys within the thresholds."""
    fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    for at in range(0, len(fps), 4096):
        some, cols = fps[at:at + 4096], []
        for k, part in enumerate(parts):
            if part.radius < 0:
                continue
            key, tag = part_keys(some, part.bits), np.int64(k << 58)
            probe = key[:, None] ^ balls[k][None, :]
            cols.append((key | tag, some, np.zeros(len(some), dtype=np.uint8)))
            cols.append((probe.ravel() | tag, np.repeat(some, probe.shape[1]),
                         np.ones(probe.size, dtype=np.uint8)))
        keys, of, flag = (np.concatenate(x) for x in zip(*cols, strict=True))
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        yield ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), keys, of, flag


def _bucket_sizes(parts: list[Part], buckets: int):
    """Batches of fingerprints -> (bucket, n), one row per bucket a task has met."""
    balls = [ball(len(p.bits), p.radius) for p in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for bucket, *_ in _probes(batch, parts, balls, buckets):
                np.add.at(n, bucket, 1)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(n[met], pa.int64())],
                                         names=["bucket", "n"])
    return run


def _in_cells(bucket, keys, of, flag, sides: dict[int, int]):
    """Cells of a bucket cut into side x side: an entry goes to a whole row of cells, a
    probe to a whole column, both chosen by the fingerprint's hash."""
    wide = np.array(sorted(sides), dtype=np.int64)
    cut = np.array([sides[b] for b in wide.tolist()], dtype=np.int64)
    at = np.searchsorted(wide, bucket)
    at[at == len(wide)] = 0
    side = np.where(wide[at] == bucket, cut[at], 1)
    take = np.repeat(np.arange(len(bucket)), side)
    step = np.arange(len(take)) - np.repeat(np.cumsum(side) - side, side)
    side = side[take]
    line = (mix64(of[take]) % side.astype(np.uint64)).astype(np.int64)
    cell = np.where(flag[take] == 0, line * side + step, step * side + line)
    return bucket[take], cell, keys[take], of[take], flag[take]


def _entries(parts: list[Part], buckets: int, sides: dict[int, int]):
    """Batches of fingerprints -> packed (bucket, cell, keys, fingerprints, probe flags)."""
    balls = [ball(len(p.bits), p.radius) for p in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, keys, of, flag in _probes(batch, parts, balls, buckets):
                cell = np.zeros(len(bucket), dtype=np.int64)
                if sides:
                    bucket, cell, keys, of, flag = _in_cells(bucket, keys, of, flag, sides)
                order = np.lexsort((cell, bucket)) if sides else np.argsort(bucket, kind="stable")
                bucket, cell = bucket[order], cell[order]
                new = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(cell) != 0)) + 1
                head = np.concatenate([[0], new])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[head], pa.int64()), pa.array(cell[head], pa.int64())]
                    + [pa.array([pack(y) for y in np.split(x[order], new)], pa.binary())
                       for x in (keys, of, flag)],
                    names=["bucket", "cell", "keys", "fps", "probe"])
    return run


def _forest(max_bits: int):
    """One bucket's entries -> a spanning forest (a, b) of its verified links."""
    def run(table: pa.Table) -> pa.Table:
        keys, fps, flag = (np.concatenate([np.frombuffer(x.as_py(), dtype=t) for x in table.column(c)])
                           for c, t in (("keys", np.int64), ("fps", np.uint64), ("probe", np.uint8)))
        nodes, number = np.unique(fps, return_inverse=True)
        at, to = np.flatnonzero(flag == 0), np.flatnonzero(flag == 1)
        at = at[np.argsort(keys[at], kind="stable")]
        lo = np.searchsorted(keys[at], keys[to], "left")
        many = np.searchsorted(keys[at], keys[to], "right") - lo
        to, lo, many = to[many > 0], lo[many > 0], many[many > 0]
        label, a_all, b_all = np.arange(len(nodes)), [], []
        held = 0
        for i, j in _slices(many, PAIR_CHUNK):
            n = many[i:j]
            left = np.repeat(number[to[i:j]], n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            right = number[at[np.repeat(lo[i:j], n) + step]]
            near = (left < right) & (label[left] != label[right])
            left, right = left[near], right[near]
            near = np.bitwise_count(nodes[left] ^ nodes[right]) <= max_bits
            a_all.append(left[near])
            b_all.append(right[near])
            held += int(near.sum())
            if held > PAIR_CHUNK:
                a, b = np.concatenate([np.arange(len(nodes)), *a_all]), np.concatenate([label, *b_all])
                label, a_all, b_all, held = local_components(len(nodes), a, b), [], [], 0
        a, b = np.concatenate([np.arange(len(nodes)), *a_all]), np.concatenate([label, *b_all])
        label = local_components(len(nodes), a, b)
        linked = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.table({"a": nodes[linked].view(np.int64), "b": nodes[label[linked]].view(np.int64)})
    return run


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of items whose sizes add up to about ``most``."""
    total, i = np.cumsum(sizes), 0
    while i < len(sizes):
        before = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, before + most, "right")))
        yield i, j
        i = j


def fingerprint_links(fps: DataFrame, max_bits: int = 4, bucket_rows: int = 1 << 20) -> DataFrame:
    """Links (a, b) whose closure equals that of all pairs within ``max_bits``.

    ``fps``: distinct, non-null (fp long), materialised by the caller."""
    spark, n = fps.sparkSession, fps.count()
    sample = fps.orderBy(F.xxhash64("fp"), "fp").limit(PLAN_SAMPLE).toPandas()["fp"]
    parts = plan_parts(sample.to_numpy(dtype=np.int64).view(np.uint64), n, max_bits)
    rows = n * sum(1 + len(ball(len(p.bits), p.radius)) for p in parts if p.radius >= 0)
    buckets = max(shuffle_partitions(spark), -(-rows // bucket_rows))
    spread = fps.select("fp").repartition(shuffle_partitions(spark))
    sizes = spread.mapInArrow(_bucket_sizes(parts, buckets), "bucket long, n long")
    # fewer than half the buckets can hold over twice the mean
    wide = sizes.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * bucket_rows)
    sides = {r["bucket"]: -(-r["n"] // bucket_rows) for r in wide.collect()}
    packed = spread.mapInArrow(_entries(parts, buckets, sides),
                               "bucket long, cell long, keys binary, fps binary, probe binary")
    return packed.groupBy("bucket", "cell").applyInArrow(_forest(max_bits), "a long, b long")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per document: (doc_id, fp, root, component_id).

    component_id is the smallest id reachable over links of at most
    ``max_bits`` differing bits, the document's own id included."""
    rows = materialise(with_fingerprint(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        "text", shingle_words).select("doc_id", "fp"))
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(fingerprint_links(classes.select("fp"), max_bits))
    member = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    of = member.join(lowest, "root").select("fp", "root", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """Keep one document of each component: the one with the smallest id.

    Rows that share that id and fingerprint are repeats; the one with the
    smallest text stays.  A component without any id keeps one row."""
    found = components(docs, id_col, text_col, shingle_words, max_bits)
    keep = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "fp")).alias("k")).select(
        F.col("k.doc_id").alias("__kid"), F.col("k.fp").alias("__kfp"))
    rows = with_fingerprint(docs, text_col, shingle_words, "__fp")
    kept = rows.join(keep.hint("shuffle_hash"),
                     F.col(id_col).eqNullSafe(F.col("__kid")) & (F.col("__fp") == F.col("__kfp")),
                     "left_semi")
    first = Window.partitionBy(F.col(id_col), F.col("__fp")).orderBy(F.col(text_col))
    return (kept.withColumn("__rn", F.row_number().over(first)).where("__rn = 1")
            .drop("__fp", "__rn"))
