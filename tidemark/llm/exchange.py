"""Hash exchange of packed keys between groups of documents.

Documents are dealt to groups of a few megabytes by a hash. Every group reduces its
rows to sorted distinct 56-bit keys and sends each hash range ("bucket") its part
as one packed row; a bucket answers with one value per key in the same order.  A key
that is everywhere costs a bucket one entry per group, not one per occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_partitions

KEY_BITS = 56                    # n keys: about n**2 / 2**57 colliding pairs
GROUP_BYTES = 8 << 20


def grouped(docs: DataFrame, id_col: str, text_col: str,
            group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """((grp, doc_id, text), number of groups); null texts are empty."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, min(shuffle_partitions(docs.sparkSession), size // 4096), -(-size // group_bytes))
    grp = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(n)).cast("int")
    return base.select(grp.alias("grp"), "doc_id", "text"), int(n)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Hash range of a key: ascending with the key."""
    return ((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


def squeeze(a: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def expand(raw: bytes, n: int, dtype) -> np.ndarray:
    item = np.dtype(dtype).itemsize
    flat = pa.decompress(raw, decompressed_size=n * item, codec="zstd", asbytes=True)
    planes = np.frombuffer(flat, dtype=np.uint8).reshape(item, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(n)


def squeeze_keys(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_keys(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(expand(raw, n, np.uint64), dtype=np.uint64)


def key_rows(grp: int, keys: np.ndarray, values: np.ndarray, buckets: int) -> pa.Table:
    """Packed rows (bucket, grp, n, keys, vals) of ascending distinct keys."""
    b = bucket_of(keys, buckets).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]]) if len(b) else np.array([0])
    rows = [(int(b[i]), grp, int(j - i), squeeze_keys(keys[i:j]), squeeze(values[i:j]))
            for i, j in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(5)],
                    schema=pa.schema([("bucket", pa.int32()), ("grp", pa.int32()),
                                      ("n", pa.int64()), ("keys", pa.binary()),
                                      ("vals", pa.binary())]))


KEY_ROWS = "bucket int, grp int, n long, keys binary, vals binary"


def bucket_keys(table: pa.Table, dtype) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's rows: groups, sizes, all keys end to end and their values."""
    grp, n = table.column("grp").to_pylist(), table.column("n").to_pylist()
    keys = [expand_keys(k.as_py(), m) for k, m in zip(table.column("keys"), n, strict=True)]
    vals = [expand(v.as_py(), m, dtype) for v, m in zip(table.column("vals"), n, strict=True)]
    return grp, np.array(n, dtype=np.int64), np.concatenate(keys), np.concatenate(vals)


def answer_rows(bucket: int, grp: list[int], n: np.ndarray, answers: np.ndarray) -> pa.Table:
    parts = np.split(answers, np.cumsum(n)[:-1])
    return pa.table({"grp": pa.array(grp, pa.int32()),
                     "bucket": pa.array([bucket] * len(grp), pa.int32()),
                     "n": pa.array(n, pa.int64()),
                     "vals": pa.array([squeeze(p) for p in parts], pa.binary())})


ANSWER_ROWS = "grp int, bucket int, n long, vals binary"


def answers(table: pa.Table, dtype) -> np.ndarray:
    """A group's answers, in the order of its ascending keys."""
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("n").to_pylist(),
                      table.column("vals").to_pylist(), strict=True), key=lambda r: r[0])
    parts = [expand(v, n, dtype) for _, n, v in rows]
    return np.concatenate(parts) if parts else np.empty(0, dtype=dtype)
