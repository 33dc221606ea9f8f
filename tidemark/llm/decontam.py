"""Benchmark decontamination by template canonicalisation.

Texts become word sequences in which numbers, names (capitalised words inside a
sentence) and units after a number are typed placeholders.  Windows of template
words are hashed and joined with those of the benchmark; neighbouring hits on one
diagonal form a run; a run counts if it covers ``min_run`` words (or the whole
item, if that is shorter) and its slots are consistent: equal item fillers are
equal in the document and different ones differ.  So a question asked again with
other numbers or names is caught, and text that merely has a number at the same
places is not.  An inconsistent run is searched for its maximal stretches: verbatim
and consistent ones of ``min_run`` words count.

The type of a word hangs on the punctuation before it, so windows of lower-cased words
without types are joined too: a verbatim passage of ``min_run`` words is found whatever
its marks, line breaks or case, also inside an inconsistent run.

The benchmark is read in blocks of at most ``block_words`` words.  One block's tables are
broadcast at a time, whatever the benchmark's size: with more than one block the documents
found so far are written to the shared folder before the next one is read, a pass over
the texts for each block.

Defined cases: null or empty texts and items match nothing; an item without an id counts
and is listed as null; an item with fewer words than a window is matched whole; runs of
placeholders alone do not count; repeated items each count; repeated rows get equal
results; very long texts are scanned whole; an empty benchmark leaves every document
clean.  Columns named contaminated, items or leaks are replaced, others are kept.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytescan import (DIGIT, LOWER, WORD, chunks, joined, span_hashes, spans,
                                   window_hashes)
from tidemark.llm.common import materialise

WINDOW = 8
MIN_RUN = 13
BLOCK_WORDS = 1 << 20
PLAIN, NUMBER, NAME, UNIT = range(4)
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr day days week weeks month "
         "months year years hour hours minute minutes second seconds meter meters metre metres "
         "mile miles inch inches foot feet gram grams liter liters litre litres percent dollar "
         "dollars euro euros cent cents degree degrees").split()
_SLOT = np.array([0, 0xA5A5A5A55A5A5A5B, 0xC3C3C3C33C3C3C3D, 0x9696969669696967], dtype=np.uint64)
LEAKS = "array<struct<item:long,kind:string,start:int,end:int>>"


def _hash_words(words: list[str]) -> np.ndarray:
    buf, at = joined([w.encode() for w in words])
    size = np.array([len(w.encode()) for w in words], dtype=np.int64)
    return span_hashes(buf, at, at + size)


_UNIT_HASHES = np.sort(_hash_words(UNITS))


@dataclass
class Words:
    start: np.ndarray      # byte offsets in the joined buffer
    end: np.ndarray
    text: np.ndarray       # number of the text
    surface: np.ndarray    # hash of the lower-cased word
    kind: np.ndarray
    template: np.ndarray   # surface hash, or the placeholder's


def _code_points() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point below 2**16: its lower case of as many bytes, and if it is a mark."""
    low, mark = np.arange(1 << 16), np.zeros(1 << 16, dtype=bool)
    for c in range(128, 1 << 16):
        if not 0xD800 <= c < 0xE000:
            x = chr(c)
            y = x.lower()
            if len(y) == 1 and len(y.encode()) == len(x.encode()):
                low[c] = ord(y)
            mark[c] = unicodedata.category(x)[0] in "PZ"
    return low, mark


_LOW, _MARK = _code_points()


def folded(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes, and which bytes belong to words."""
    out, inside = LOWER[buf], WORD[buf]
    two = np.flatnonzero((buf >= 0xC2) & (buf < 0xE0))
    code = ((buf[two] & 0x1F).astype(np.int64) << 6) | (buf[two + 1] & 0x3F)
    out[two], out[two + 1] = 0xC0 | _LOW[code] >> 6, 0x80 | _LOW[code] & 0x3F
    inside[two] = inside[two + 1] = ~_MARK[code]
    three = np.flatnonzero((buf >= 0xE0) & (buf < 0xF0))
    code = (((buf[three] & 0x0F).astype(np.int64) << 12) | ((buf[three + 1] & 0x3F).astype(np.int64) << 6)
            | (buf[three + 2] & 0x3F))
    out[three], out[three + 1] = 0xE0 | _LOW[code] >> 12, 0x80 | _LOW[code] >> 6 & 0x3F
    out[three + 2] = 0x80 | _LOW[code] & 0x3F
    inside[three] = inside[three + 1] = inside[three + 2] = ~_MARK[code]
    return out, inside


def _capital(buf: np.ndarray, lower: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Words whose first character, of up to three bytes, has another lower case."""
    out = buf[start] != lower[start]
    for more, lead in ((1, 0xC2), (2, 0xE0)):
        at = np.minimum(start + more, len(buf) - 1)
        out |= (buf[start] >= lead) & (buf[start] < 0xF0) & (start + more < len(buf)) & (buf[at] != lower[at])
    return out


def words_of(buf: np.ndarray, first: np.ndarray) -> Words:
    """The typed words of joined texts."""
    lower, inside = folded(buf)
    point = np.flatnonzero((buf == 46) | (buf == 44))            # 3.5 and 1,000 are one word
    point = point[(point > 0) & (point < len(buf) - 1)]
    inside[point[DIGIT[buf[point - 1]] & DIGIT[buf[point + 1]]]] = True
    start, end = spans(inside)
    surface = span_hashes(lower, start, end)
    kind = np.zeros(len(start), dtype=np.int8)
    digit = DIGIT[buf[start]]
    kind[digit] = NUMBER
    # a capital inside a sentence: the last byte before it, blanks aside, ends none
    seen = np.where((buf == 32) | (buf == 9), -1, np.arange(len(buf)))
    seen = np.maximum.accumulate(seen)
    before = np.where(start > 0, seen[np.maximum(start - 1, 0)], -1)
    opens = (before < 0) | np.isin(buf[np.maximum(before, 0)], np.frombuffer(b".!?:\n\r\0", np.uint8))
    kind[_capital(buf, lower, start) & ~opens] = NAME
    text = np.searchsorted(first, start, "right") - 1
    unit = np.zeros(len(start), dtype=bool)
    if len(start) > 1:
        at = np.flatnonzero((kind[:-1] == NUMBER) & (kind[1:] == PLAIN) & (text[:-1] == text[1:])) + 1
        unit[at] = np.isin(surface[at], _UNIT_HASHES)
    kind[unit] = UNIT
    return Words(start, end, text, surface, kind, np.where(kind > 0, _SLOT[kind], surface))


@dataclass
class Windows:
    """The sorted hashes of an item list's windows, by width."""
    hashes: dict[int, np.ndarray]
    at: dict[int, np.ndarray]    # word number of each window
    sieve: dict[int, np.ndarray]


@dataclass
class Block:
    """A part of the benchmark: its words and windows."""
    items: list[int | None]      # item ids
    first: np.ndarray            # first word of each item, and one past the last
    surface: np.ndarray
    kind: np.ndarray
    typed: Windows               # of templates
    plain: Windows               # of lower-cased words


def _index(value: np.ndarray, w: Words, size: np.ndarray, window: int, mixed: bool) -> Windows:
    """Windows of ``value``; of a shorter item the whole; ``mixed``: none of slots alone."""
    out = Windows({}, {}, {})
    for width in sorted({window, *(int(s) for s in size if 0 < s < window)}):
        h = window_hashes(value, width)
        i = np.arange(len(h))
        ok = w.text[i] == w.text[i + width - 1] if len(h) else np.zeros(0, dtype=bool)
        if width < window:
            ok &= size[w.text[i]] == width
        if mixed or width < window:
            slots = np.concatenate([[0], np.cumsum(w.kind > 0)])
            ok &= slots[i + width] - slots[i] < width
        i = i[ok]
        i = i[np.argsort(h[i], kind="stable")]
        if len(i):
            out.hashes[width], out.at[width] = h[i], i
            out.sieve[width] = np.zeros(1 << 20, dtype=bool)
            out.sieve[width][(h[i] >> np.uint64(44)).astype(np.int64)] = True
    return out


def make_block(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> Block:
    buf, first = joined([(t or "").encode("utf-8") for _, t in items])
    w = words_of(buf, first)
    bound = np.searchsorted(w.text, np.arange(len(items) + 1))
    size = np.diff(bound)
    return Block([i for i, _ in items], bound, w.surface, w.kind,
                 _index(w.template, w, size, window, True), _index(w.surface, w, size, window, False))


def consistent(item: np.ndarray, doc: np.ndarray) -> bool:
    """The fillers of the slots map one to one."""
    pairs = {(int(a), int(b)) for a, b in zip(item, doc, strict=True)}
    return len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def stretches(item: np.ndarray, doc: np.ndarray, at: np.ndarray, n: int,
              min_run: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of what counts in an inconsistent run of n words with slots at ``at``."""
    cuts = [-1, *at[item != doc].tolist(), n]
    for a, b in pairwise(cuts):
        if b - a - 1 >= min_run:
            yield a + 1, b, "verbatim"
    there, back, pairs = {}, {}, Counter()
    low = start = 0
    fillers = list(zip(item.tolist(), doc.tolist(), at.tolist(), strict=True))
    for k, (x, y, place) in enumerate([*fillers, (None, None, n)]):
        clash = place == n or there.get(x, y) != y or back.get(y, x) != x
        if clash and place - start >= min_run:
            same = all(a == b for a, b, _ in fillers[low:k])
            yield start, place, "verbatim" if same else "reparameterised"
        while place < n and (there.get(x, y) != y or back.get(y, x) != x):
            a, b, start = fillers[low]
            low, start = low + 1, start + 1
            pairs[a, b] -= 1
            if not pairs[a, b]:
                del there[a], back[b]
        there[x], back[y] = y, x
        pairs[x, y] += 1


def _runs(value: np.ndarray, w: Words, windows: Windows, block: Block,
          min_run: int) -> Iterator[tuple[int, int, int, int]]:
    """(number of the item, its word, the text's word, length) of the runs on one diagonal."""
    for width, keys in windows.hashes.items():
        h = window_hashes(value, width)
        pos = np.flatnonzero(windows.sieve[width][(h >> np.uint64(44)).astype(np.int64)])
        pos = pos[w.text[pos] == w.text[pos + width - 1]]
        lo = np.searchsorted(keys, h[pos], "left")
        many = np.searchsorted(keys, h[pos], "right") - lo
        pos, lo, many = pos[many > 0], lo[many > 0], many[many > 0]
        if not len(pos):
            continue
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        i = windows.at[width][np.repeat(lo, many) + step]
        p = np.repeat(pos, many)
        item = np.searchsorted(block.first, i, "right") - 1
        order = np.lexsort((p, p - i, item, w.text[p]))
        p, i, item = p[order], i[order], item[order]
        new = np.ones(len(p), dtype=bool)
        new[1:] = ~((w.text[p][1:] == w.text[p][:-1]) & (item[1:] == item[:-1])
                    & (p[1:] == p[:-1] + 1) & (i[1:] == i[:-1] + 1))
        heads = np.flatnonzero(new)
        n = np.diff(np.append(heads, len(p))) + width - 1
        own = block.first[item[heads] + 1] - block.first[item[heads]]
        long = n >= np.minimum(min_run, own)
        heads, n = heads[long], n[long]
        yield from zip(item[heads].tolist(), i[heads].tolist(), p[heads].tolist(), n.tolist(),
                       strict=True)


def leaks_in(run: list[bytes], block: Block, window: int, min_run: int) -> dict[int, list[tuple]]:
    """text number -> [(item id, kind, start, end)], offsets in code points."""
    buf, first = joined(run)
    w = words_of(buf, first)
    seen: dict[tuple[int, int], set[tuple]] = {}     # (text, item) -> (first word, end, kind)
    for k, i0, p0, n in _runs(w.template, w, block.typed, block, min_run):
        slot = np.flatnonzero(block.kind[i0:i0 + n] > 0)
        mine, theirs = block.surface[i0:i0 + n][slot], w.surface[p0:p0 + n][slot]
        if consistent(mine, theirs):
            same = np.array_equal(mine, theirs)
            parts = [(0, n, "verbatim" if same else "reparameterised")]
        else:
            parts = stretches(mine, theirs, slot, n, min_run)
        for x, y, kind in parts:
            seen.setdefault((int(w.text[p0]), k), set()).add((p0 + x, p0 + y, kind))
    for k, i0, p0, n in _runs(w.surface, w, block.plain, block, min_run):
        t = int(w.text[p0])
        if (block.kind[i0:i0 + n] > 0).all():
            continue
        parts = seen.setdefault((t, k), set())
        if not any(a <= p0 and p0 + n <= b for a, b, _ in parts):
            parts -= {x for x in parts if x[2] == "verbatim" and p0 <= x[0] and x[1] <= p0 + n}
            parts.add((p0, p0 + n, "verbatim"))
    found: dict[int, list[tuple]] = {}
    for (t, k), parts in seen.items():
        body = run[t]
        for a, b, kind in parts:
            s, e = int(w.start[a] - first[t]), int(w.end[b - 1] - first[t])
            s, e = len(body[:s].decode("utf-8", "ignore")), len(body[:e].decode("utf-8", "ignore"))
            found.setdefault(t, []).append((block.items[k], kind, s, e))
    return {t: sorted(set(v), key=lambda x: (x[0] is None, x)) for t, v in found.items()}


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(
        "t is not null").orderBy(F.col("i").asc_nulls_last(), "t")
    for row in rows.toLocalIterator():
        n = 1 + row["t"].count(" ")
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((row["i"], row["t"]))
        size += n
    if block:
        yield block


def _scanner(shared, window: int, min_run: int):
    @F.pandas_udf(LEAKS)
    def scan(text: pd.Series) -> pd.Series:
        out: list[list[dict]] = [[] for _ in range(len(text))]
        for at, run in chunks(text.tolist()):
            for t, v in leaks_in(run, shared.value, window, min_run).items():
                out[at + t] = [dict(zip(("item", "kind", "start", "end"), x, strict=True))
                               for x in v]
        return pd.Series(out)
    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
               min_run: int = MIN_RUN, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with contaminated, items (sorted item ids) and leaks (runs)."""
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item_id, item_text, block_words)
    rows, found = next(blocks, None), docs.withColumn("leaks", F.array().cast(LEAKS))
    while rows is not None:
        shared = spark.sparkContext.broadcast(make_block(rows, window))
        found = found.withColumn("leaks", F.concat("leaks", _scanner(shared, window, min_run)(F.col(text_col))))
        rows = next(blocks, None)
        if rows is not None:
            found = materialise(found)
            shared.unpersist()
    return (found.withColumn("items", F.array_sort(F.array_distinct(
                F.transform("leaks", lambda x: x["item"]))))
            .withColumn("contaminated", F.size("leaks") > 0))
