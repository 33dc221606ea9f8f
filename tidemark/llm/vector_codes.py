"""Vector code compression over per-dimension value dictionaries.

Vectors of integers are cut into parts, and every part is coded by the nearest entry of
its position's codebook (product quantisation, trained by Lloyd rounds in integers).

Rows are taken in chunks.  A chunk stores, for each dimension, the distinct integers that
occur there and every row's code into them, once.  A round tabulates the squared
differences of the distinct integers to all entries; the distances of all rows to all
entries are then gathers of table rows by code, added up over the part's dimensions.
The sums of new entries come from counts of (entry, code) pairs in the same way.  A
dictionary never holds more values than its chunk has rows, whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

BROADCAST_LABELS = 100_000
SUMS = "part int, entry int, dim int, n bigint, total bigint"


def kept_vectors(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector and all its components are given and finite."""
    good = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vec_col).isNotNull() & F.coalesce(good, F.lit(False)))


def scaled(values: np.ndarray, scale: int, width: int) -> np.ndarray:
    """floor(scale * x); a range whose squared distances pass 64 bits is an error."""
    out = np.floor(values.astype(np.float64) * scale)
    if len(out) and 4 * max(1, width) * float(np.abs(out).max()) ** 2 >= 2.0 ** 63:
        raise ValueError("components are too large for 64-bit squared distances")
    return out.astype(np.int64)


def _encode(batch: pa.RecordBatch, width: int, scale: int) -> pa.RecordBatch:
    """One chunk: ids, labels, and per dimension the values and the rows' codes."""
    vectors = batch.column(2)
    if set(np.diff(np.asarray(vectors.offsets))) - {width}:
        raise ValueError(f"vectors of more than one length; the first has {width}")
    x = scaled(vectors.flatten().to_numpy(zero_copy_only=False), scale, width).reshape(-1, width)
    values, codes = [], []
    for d in range(width):
        v, c = np.unique(x[:, d], return_inverse=True)
        values.append(v)
        codes.append(c.astype(np.uint16 if len(v) <= 1 << 16 else np.uint32).tobytes())
    one = pa.array([0, batch.num_rows], pa.int32())
    flat = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32),
                                    np.concatenate(values) if values else np.empty(0, np.int64))
    per_dim = pa.array([0, width], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(one, batch.column(0)), pa.ListArray.from_arrays(one, batch.column(1)),
         pa.ListArray.from_arrays(per_dim, flat),
         pa.ListArray.from_arrays(per_dim, pa.array(codes, pa.binary()))],
        names=["ids", "labels", "vals", "codes"])


def chunks(df: DataFrame, width: int, scale: int) -> DataFrame:
    """(ids, labels, vals, codes): a row for every Arrow batch of (id, label, vec)."""
    kinds = dict(df.dtypes)
    schema = (f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, "
              "vals array<array<bigint>>, codes array<binary>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _encode(batch, width, scale)

    return df.select("id", "label", "vec").mapInArrow(run, schema)


def _unpack(batch: pa.RecordBatch, i: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    n = len(batch.column("ids")[i])
    values = [np.asarray(v.values) for v in batch.column("vals")[i]]
    codes = [np.frombuffer(c.as_py(), np.uint16 if len(v) <= 1 << 16 else np.uint32)[:n]
             for v, c in zip(values, batch.column("codes")[i], strict=True)]
    return values, codes


def nearest(values: list[np.ndarray], codes: list[np.ndarray], n: int,
            book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, distance), each (parts, n): ties go to the lower entry.

    ``book`` is (parts, entries, part width).
    """
    entry = np.zeros((len(book), n), dtype=np.int64)
    error = np.zeros((len(book), n), dtype=np.int64)
    for part, entries in enumerate(book):
        total = np.zeros((n, len(entries)), dtype=np.int64)
        for j in range(entries.shape[1]):
            d = part * entries.shape[1] + j
            table = (values[d][:, None] - entries[None, :, j]) ** 2
            total += table[codes[d]]
        entry[part] = total.argmin(axis=1)
        error[part] = np.take_along_axis(total, entry[part][:, None], 1)[:, 0]
    return entry, error


def _round(coded: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after one round; one row for each number of the books comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(book.shape[:2], dtype=np.int64)
        total = np.zeros(book.shape, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _unpack(batch, i)
                n = len(batch.column("ids")[i])
                entry, _ = nearest(values, codes, n, book)
                for part in range(len(book)):
                    count[part] += np.bincount(entry[part], minlength=book.shape[1])
                    for j in range(book.shape[2]):
                        d = part * book.shape[2] + j
                        pairs = np.bincount(entry[part] * len(values[d]) + codes[d],
                                            minlength=book.shape[1] * len(values[d]))
                        total[part, :, j] += pairs.reshape(book.shape[1], -1) @ values[d]
        part, entry, dim = (x.ravel().astype(np.int32) for x in np.indices(book.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(dim), pa.array(count[part, entry]),
             pa.array(total.ravel())], names=["part", "entry", "dim", "n", "total"])

    out = book.copy()
    for r in (coded.mapInArrow(run, SUMS).groupBy("part", "entry", "dim")
              .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where("n > 0").collect()):
        out[r["part"], r["entry"], r["dim"]] = r["total"] // r["n"]     # Python's // goes down
    return out


def _assigned(coded: DataFrame, book: np.ndarray) -> DataFrame:
    kinds = {k: v[6:-1] for k, v in coded.dtypes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _unpack(batch, i)
                n = len(batch.column("ids")[i])
                entry, error = nearest(values, codes, n, book)
                raw = np.ascontiguousarray(entry.T.astype(np.uint8)).tobytes().hex()
                step = 2 * len(book)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values,
                     pa.array([raw[step * k:step * (k + 1)] for k in range(n)], pa.string()),
                     pa.array(error.sum(axis=0))], names=["id", "label", "code", "error"])

    return coded.mapInArrow(run, f"id {kinds['ids']}, label {kinds['labels']}, "
                                 "code string, error bigint")


def books_sha256(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
             label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6,
             scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error, label_error), codebooks).

    Rows whose vector is null or holds null or non-finite components are left out.
    Codebooks start as the parts of the ``entries`` smallest ids (fewer rows: fewer
    entries; null ids come last; equal ids by vector), and after every round an entry is
    the floored mean of its parts, or stays if it has none.  ``code`` has two hex digits
    for each part; ``error`` is the sum of the parts' squared distances, ``label_error``
    its sum over rows of equal label, null labels together.

    Repeated rows count each time.  Ties go to the lower entry.  Other columns, whatever
    their names, are not looked at.  An empty table gives an empty table.  Vectors of more
    than one length, a length that the parts do not divide, more than 256 entries, and
    components whose squared distances pass 64 bits raise an error.  Text plays no part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = kept_vectors(df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                                  F.col(vec_col).alias("vec")), "vec")
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    width = len(seeds[0]["vec"]) if seeds else 0
    if width % parts or {len(r["vec"]) for r in seeds} - {width}:
        raise ValueError(f"vectors of {width} components are not cut into {parts} equal parts")
    start = scaled(np.array([r["vec"] for r in seeds], dtype=np.float64), scale, width)
    book = start.reshape(len(seeds), parts, width // parts).transpose(1, 0, 2).copy()
    coded = materialise(chunks(rows, width, scale))
    for _ in range(rounds if seeds else 0):
        book = _round(coded, book)
    found = materialise(_assigned(coded, book))
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    if totals.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        totals = F.broadcast(totals)
    totals = totals.withColumnRenamed("label", "of")
    out = (found.join(totals, F.col("label").eqNullSafe(F.col("of")))
           .select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error",
                   "label_error"))
    return out, book
