"""Text functions: tokeniser, hashed dimension, in-row term vectors.

The tokeniser and the hash are part of the index format, so the fixed values
below must not change: a different value gives different dimensions and
therefore different scores.  Both exist as built-ins for single columns; term
vectors of whole texts are counted on Arrow batches.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the index format.
DIM = 16384                      # size of the hashed vector space (2**14)
SPLIT_PATTERN = "[^a-z0-9]+"     # separators after lower-casing
MIN_TOKEN_LENGTH = 2             # shorter tokens are dropped

TERM_TYPE = T.ArrayType(T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("tf", T.DoubleType())]))
SLICE_BYTES = 8 << 20            # of text that a task cuts at once
_SEPARATED = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for c in range(256))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """``array<string>`` of tokens: lower-case, split on non-[a-z0-9], len >= 2.

    Non-ASCII letters are separators.  A null text yields an empty array.
    """
    parts = F.split(F.lower(F.coalesce(_col(text), F.lit(""))), SPLIT_PATTERN, -1)
    return F.filter(parts, lambda t: F.length(t) >= MIN_TOKEN_LENGTH)


def token_dim(token) -> Column:
    """First 4 bytes of SHA-256 (big-endian, unsigned) modulo DIM, as int."""
    head = F.substring(F.sha2(_col(token), 256), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(DIM)).cast("int")


def concat_text(*cols) -> Column:
    """The indexed text: columns joined by one space (nulls read as empty)."""
    if len(cols) == 1:
        return F.coalesce(_col(cols[0]), F.lit(""))
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in cols])


def _count_terms(texts: list[str | None]) -> pa.ListArray:
    """The term vector of every text.

    The texts are cut at once; a token is looked at (with the separators behind it) once
    however often it occurs, and (text, dimension) pairs are counted by sorting.
    """
    raw = [(t or "").lower().encode() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in raw])
    data = np.frombuffer(b"".join(t + b" " for t in raw).translate(_SEPARATED), np.uint8)
    starts = data != 32
    starts[1:] &= data[:-1] == 32
    cuts = np.append(np.flatnonzero(starts), len(data))
    tokens = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
    known = [t.rstrip() for t in tokens.dictionary.to_pylist()]
    dims = np.array([int.from_bytes(hashlib.sha256(t).digest()[:4], "big") % DIM
                     if len(t) >= MIN_TOKEN_LENGTH else -1 for t in known], np.int64)[tokens.indices.to_numpy()]
    rows = np.searchsorted(ends, cuts[:-1], side="right")
    found, counts = np.unique(rows[dims >= 0] * DIM + dims[dims >= 0], return_counts=True)
    terms = pa.StructArray.from_arrays([pa.array(found % DIM, pa.int32()), pa.array(counts, pa.float64())],
                                       names=["dim", "tf"])
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(found, np.arange(len(texts) + 1) * DIM), pa.int32()), terms)


@F.arrow_udf(TERM_TYPE)
def _terms(texts: pa.Array) -> pa.Array:
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    parts, at = [], 0
    while at < len(texts) or not parts:                    # about SLICE_BYTES of text at a time
        done = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES, side="right")))
        parts.append(_count_terms(texts.slice(at, end - at).to_pylist()))
        at = end
    return pa.concat_arrays(parts)


def term_vectors(df: DataFrame, text, keep: list[str],
                 out: str = "terms") -> DataFrame:
    """Add ``out``: the raw term-frequency vector of ``text``, in the row.

    ``out`` is ``array<struct<dim:int, tf:double>>`` sorted by dim; terms
    whose hashes collide are one term.  Tokens and dimensions are those of
    :func:`tokenize` and :func:`token_dim`.  The count is done inside the row,
    so a document's terms never leave its row and no shuffle is needed; it runs
    on Arrow batches, where a token is hashed once however often it occurs.
    """
    return df.select(*keep, _terms(_col(text).cast("string")).alias(out))


def vector_norm(terms, field: str = "tf") -> Column:
    """L2 norm of a term vector column; a zero norm reads as 1.0."""
    ss = F.aggregate(_col(terms), F.lit(0.0).cast("double"),
                     lambda acc, e: acc + e[field] * e[field])
    return F.coalesce(F.nullif(F.sqrt(ss), F.lit(0.0)), F.lit(1.0))
