"""Vectorised tokens over the UTF-8 bytes of a batch of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

CHUNK_BYTES = 1 << 20
LONG_WORD = 48                     # longer words are hashed one by one
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)   # ASCII letters and digits, every non-ASCII byte
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True


def chunks(texts: list[str | None], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, encoded texts) in runs of about ``most`` bytes."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8")
        if run and size + len(b) > most:
            yield first, run
            first, run, size = i, [], 0
        run.append(b)
        size += len(b)
    if run:
        yield first, run


def joined(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end with a zero byte after each, and their starts."""
    buf = np.frombuffer(b"\0".join(run) + b"\0", dtype=np.uint8)
    size = np.fromiter(map(len, run), dtype=np.int64, count=len(run)) + 1
    return buf, np.cumsum(size) - size


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs."""
    step = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    return h ^ (h >> np.uint64(29))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    size = end - start
    h = size.astype(np.uint64) * _M1
    at = np.flatnonzero(size <= LONG_WORD)
    for k in range(min(int(size.max(initial=0)), LONG_WORD)):
        at = at[size[at] > k]
        h[at] = (h[at] ^ buf[start[at] + k]) * _M1
        h[at] ^= h[at] >> np.uint64(31)
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes())
    return mix64(h)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours of h."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = (out ^ h[k:k + n]) * _M1
        out ^= out >> np.uint64(32)
    return out
