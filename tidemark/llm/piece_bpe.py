"""SentencePiece BPE encoding by backtracking, and decoding.

The library merges the adjacent pair whose concatenation is the best-scored piece,
leftmost on ties, until no pair is a piece.  The same ids come out without merging
whole texts: a sequence of pieces is that result if and only if every two neighbours,
merged again on their own, come out as those two.  (Until a merge first crosses a
boundary, each side is merged as it is alone; the first merge to cross one would have
been the best of the two neighbours alone as well.)  So a text is read from the left,
taking the longest piece at each place (Aho-Corasick) that is compatible with its
left neighbour, else a shorter one, else giving the place up for good: a prefix has
one encoding, so a place that failed once fails whatever way it is reached.

If no piece holds a word mark after another character, a text is encoded word by
word; words that repeat are taken from a bounded cache.  A batch of texts is cut into
words at once, and its distinct words of up to ``MAX_WORD`` characters are read side by side:
in every round each word takes the longest compatible piece at its place, a shorter one or gives
the place up.  Pairs not met before are judged together, by merging them side by side.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

MARK = "▁"                 # stands for a space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MAX_WORDS, MAX_PAIRS, MAX_WORD = 400_000, 500_000, 64    # cached per worker
WIDTHS, COLUMNS = (6, 9, 12, 16, 24, 40, MAX_WORD), 16_384    # words read side by side, by length
CODES = 0x110000
NONE = np.iinfo(np.int32).max      # the key of two units that are no pair


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, raw[at:at + size]
        at += size


class PieceModel:
    """Pieces of a SentencePiece BPE model file with byte fallback.

    Other kinds of model (unigram, own normalisation rules, user-defined or unused
    pieces, no byte fallback) raise ValueError: their ids would not be exact.
    """

    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        kinds, scores, trainer, norm = [], [], {}, {}
        for number, value in _fields(raw):
            if number == 1:
                one = dict(_fields(value))
                self.pieces.append(one[1].decode())
                scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
                kinds.append(one.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        if (trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or norm.get(2)
                or norm.get(4, 1) or not norm.get(5, 1)
                or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("not a BPE model with byte fallback and identity normalisation")
        self.prefix = bool(norm.get(3, 1))
        self.score = {p: s for p, s, k in zip(self.pieces, scores, kinds, strict=True) if k == NORMAL}
        self.id = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == NORMAL}
        self.byte = [0] * 256
        self.raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for i, k in enumerate(kinds):
            if k == BYTE:
                value = int(self.pieces[i][1:-1], 16)
                self.byte[value], self.raw[i] = i, bytes([value])
            elif k in (CONTROL, UNKNOWN):
                self.raw[i] = b"" if k == CONTROL else " ⁇ ".encode()
        self.is_byte = [k == BYTE for k in kinds]
        letters = sorted(set("".join(self.id)))
        # characters that only occur inside pieces are units of their own: ids by byte fallback
        self.automaton = ahocorasick.Automaton()
        for p in {*self.id, *letters}:
            self.automaton.add_word(p, (len(p), p))
        self.automaton.make_automaton()
        self.units = {p: p for p in (*self.id, *letters)}
        known = "".join(re.escape(c) for c in letters if c != MARK)
        split = all(MARK not in p.lstrip(MARK) for p in self.id)
        self.word = re.compile(f"{MARK}*[{known}]+|{MARK}+|[^{known}{MARK}]" if split
                               else f"[{known}{MARK}]+|[^{known}{MARK}]")
        self.shorter: dict[str, str] = {}
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.words: dict[str, bytes] = {}               # ids as packed int32
        self.spaced: dict[str, bytes] = {}              # the same of what stands between two spaces
        self.by_word, self.by_space = split, split and self.prefix
        self.raw_pieces = pa.array(self.raw, pa.binary())
        self._number_units()

    def _number_units(self) -> None:
        """Units by number, their trie, and the pairs of them that are pieces, for :meth:`split_all`.

        Characters that no piece holds get a number and their bytes' ids when they are met.
        """
        number = {u: n for n, u in enumerate(self.units)}
        # ids of a unit, four at most (the bytes of a character); the last row belongs to the edge of a word
        self.edge, self.base = len(number), len(number) + 1 + CODES
        self.ids_of = np.zeros((self.edge + 1, 4), np.int32)
        self.n_ids = np.zeros(self.edge + 1, np.int32)
        for u, n in number.items():
            ids = self.unit_ids(u)
            self.ids_of[n, :len(ids)], self.n_ids[n] = ids, len(ids)
        self.unit_of = np.full(CODES, -1, np.int32)
        for u, n in number.items():
            if len(u) == 1:
                self.unit_of[ord(u)] = n
        ranks = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs = sorted((number[p[:cut]] * self.base + number[p[cut:]], ranks[s], number[p])
                       for p, s in self.score.items() for cut in range(1, len(p))
                       if p[:cut] in number and p[cut:] in number)
        self.pair_keys = np.array([k for k, _, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.pair_ranks = np.array([r for _, r, _ in pairs] + [0], np.int32)
        self.pair_units = np.array([u for _, _, u in pairs] + [0], np.int32)
        self.unit_texts = list(number)
        self.size_of = np.array([*map(len, number), 0], np.int32)
        self.shorter_of = np.array([number.get(self._shorter(u), -1) for u in number] + [-1], np.int32)
        self.letters_of = np.full((self.edge + 1, int(self.size_of.max())), self.edge, np.int32)
        nodes, steps, ends = {"": 0}, [], [-1]
        for u, n in number.items():
            for cut, c in enumerate(u):
                self.letters_of[n, cut] = number[c]
                if u[:cut + 1] not in nodes:
                    steps.append((nodes[u[:cut]] * self.edge + number[c], len(nodes)))
                    nodes[u[:cut + 1]] = len(nodes)
                    ends.append(-1)
            ends[nodes[u]] = n
        steps.sort()
        self.step_keys = np.array([k for k, _ in steps] + [np.iinfo(np.int64).max], np.int64)
        self.step_nodes = np.array([n for _, n in steps] + [0], np.int32)
        self.unit_at = np.array(ends, np.int32)
        self.known_pairs, self.known_fits = np.array([np.iinfo(np.int64).max]), np.zeros(1, bool)

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by plain merging: best score first, leftmost on ties."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            at, best = -1, -np.inf
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and s > best:
                    at, best = i, s
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str | None, right: str) -> bool:
        """Two neighbours, merged again, come out as they are (a first piece: alone)."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = (self.merge(right) == [right] if left is None
                     else self.merge(left + right) == [left, right])
            self.pairs[left, right] = known
        return known

    def _shorter(self, unit: str) -> str:
        """The longest unit that is a proper prefix, empty if there is none."""
        found = self.shorter.get(unit)
        if found is None:
            size = len(unit) - 1
            while size and unit[:size] not in self.units:
                size -= 1
            found = self.shorter[unit] = self.units.get(unit[:size], "")
        return found

    def split(self, text: str) -> list[str]:
        """Units of a text of known characters, by backtracking."""
        longest = [""] * (len(text) + 1)
        for end, (size, unit) in self.automaton.iter(text):
            longest[end + 1 - size] = unit            # later ends are longer
        failed = bytearray(len(text) // 8 + 1)        # a bit for every place
        pairs, compatible = self.pairs, self.compatible
        taken: list[str] = []
        left, at, unit = None, 0, longest[0]
        while at < len(text):
            while unit:
                end = at + len(unit)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = pairs.get((left, unit))
                    if fits or fits is None and compatible(left, unit):
                        break
                unit = self._shorter(unit)
            if unit:
                taken.append(unit)
                left, at, unit = unit, end, longest[end]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                unit = taken.pop()
                at -= len(unit)
                left = taken[-1] if taken else None
        return taken

    def unit_ids(self, unit: str) -> list[int]:
        known = self.id.get(unit)
        return [known] if known is not None else [self.byte[b] for b in unit.encode()]

    def word_ids(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = np.array([i for u in (self.split(word) if word[0] in self.units else [word])
                              for i in self.unit_ids(u)], dtype=np.int32).tobytes()
            if len(word) <= MAX_WORD:
                if len(self.words) >= MAX_WORDS:
                    self.words.clear()
                self.words[word] = found
        return found

    def spaced_ids(self, part: str) -> bytes:
        """Ids of what stands between two spaces, with the mark of the first."""
        found = b"".join(map(self.word_ids, self.word.findall(MARK + part)))
        if len(part) <= MAX_WORD:
            if len(self.spaced) >= MAX_WORDS:
                self.spaced.clear()
            self.spaced[part] = found
        return found

    def packed(self, text: str | None) -> np.ndarray:
        """Ids of a text, as int32, without begin or end ids; null and empty texts have none."""
        if not text:
            return np.empty(0, np.int32)
        if self.by_space and MARK not in text and "  " not in text and " " not in (text[0], text[-1]):
            words, known, ids = text.split(" "), self.spaced, self.spaced_ids   # one mark before each
        else:
            words, known, ids = self.word.findall(
                (MARK if self.prefix else "") + text.replace(" ", MARK)), self.words, self.word_ids
        found = list(map(known.get, words))
        if None in found:
            found = [f or ids(w) for f, w in zip(found, words, strict=True)]
        return np.frombuffer(b"".join(found), dtype=np.int32)

    def _characters(self, words: list[str]) -> np.ndarray:
        """Unit numbers of the characters of all words; a space is a mark."""
        codes = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), np.uint32)
        units = self.unit_of[codes]
        if len(units) and units.min() < 0:
            new = np.unique(codes[units < 0])
            ids = [[self.byte[b] for b in chr(c).encode()] for c in new]
            self.unit_of[new] = np.arange(len(self.n_ids), len(self.n_ids) + len(new))
            self.ids_of = np.concatenate([self.ids_of, np.array([i + [0] * (4 - len(i)) for i in ids], np.int32)])
            self.n_ids = np.concatenate([self.n_ids, np.array([len(i) for i in ids], np.int32)])
            self.size_of = np.concatenate([self.size_of, np.ones(len(new), np.int32)])
            self.shorter_of = np.concatenate([self.shorter_of, np.full(len(new), -1, np.int32)])
            units = self.unit_of[codes]
        return units

    def _pairs(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, merged unit) of neighbours: the least key is the best score, leftmost on ties."""
        wanted = left * np.int64(self.base) + right
        at = np.searchsorted(self.pair_keys, wanted)
        return (np.where(self.pair_keys[at] == wanted, self.pair_ranks[at] * np.int32(MAX_WORD) + place, NONE),
                self.pair_units[at])

    def _merge_columns(self, units: np.ndarray) -> np.ndarray:
        """Words of like length, one in each column, ``edge`` below their ends: merged, -1 where
        a unit went into the one before it."""
        width, n = units.shape
        sym = np.vstack([units, np.full((1, n), self.edge, np.int32)])      # row `width`: the edges
        after = np.repeat(np.arange(1, width + 2, dtype=np.int32)[:, None], n, axis=1)
        before = np.repeat(np.arange(-1, width, dtype=np.int32)[:, None], n, axis=1)
        after[width], before[0] = width, width
        key, merged = self._pairs(sym[:-1], sym[1:], np.arange(width, dtype=np.int32)[:, None])
        key, merged = np.vstack([key, np.full((1, n), NONE, np.int32)]), np.vstack([merged, merged[-1:]])
        live = np.arange(n)
        while True:
            best = key.min(axis=0)
            going = best < NONE
            if not going.all():
                live, key, best = live[going], key[:, going], best[going]
            if not len(live):
                return sym[:width]
            own = np.arange(len(live))
            at = best % MAX_WORD
            gone = after[at, live]
            nxt, prev = after[gone, live], before[at, live]
            unit = merged[at, live]
            sym[at, live], sym[gone, live] = unit, -1
            after[at, live], before[nxt, live] = nxt, at
            key[gone, own] = NONE
            key[at, own], merged[at, live] = self._pairs(unit, sym[nxt, live], at)
            key[prev, own], merged[prev, live] = self._pairs(sym[prev, live], unit, prev)

    def _judge(self, keys: np.ndarray) -> np.ndarray:
        """:meth:`compatible` of many pairs of units; the edge on the left stands for no neighbour."""
        left, right = keys // self.base, keys % self.base
        first, sizes = self.size_of[left], self.size_of[left] + self.size_of[right]
        fits = np.zeros(len(keys), bool)
        at = 0
        order = np.argsort(sizes, kind="stable")
        for width in WIDTHS:
            end = int(np.searchsorted(sizes[order], width, side="right"))
            for start in range(at, end, COLUMNS):
                rows = order[start:min(end, start + COLUMNS)]
                units = np.full((len(rows), width), self.edge, np.int32)
                letters = self.letters_of[np.stack([left[rows], right[rows]], 1)].reshape(len(rows), -1)
                units[np.arange(width) < sizes[rows][:, None]] = letters[letters != self.edge]
                units = self._merge_columns(np.ascontiguousarray(units.T))
                alone = left[rows] == self.edge
                own = np.arange(len(rows))
                fits[rows] = ((units[0] == np.where(alone, right[rows], left[rows]))
                              & (alone | (units[np.minimum(first[rows], width - 1), own] == right[rows]))
                              & (((units >= 0) & (units != self.edge)).sum(axis=0) == 2 - alone))
            at = end
        for r in order[at:]:                                           # long pairs
            one = None if left[r] == self.edge else self.unit_texts[left[r]]
            fits[r] = self.compatible(one, self.unit_texts[right[r]])
        return fits

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`compatible` of neighbours; a character that no piece holds goes with all."""
        keys = np.where(left > self.edge, self.edge, left) * np.int64(self.base) + right
        at = np.searchsorted(self.known_pairs, keys)
        fits, new = self.known_fits[at], self.known_pairs[at] != keys
        fits[right > self.edge] = True
        new &= right <= self.edge
        if new.any():
            pairs, of = np.unique(keys[new], return_inverse=True)
            judged = self._judge(pairs)
            fits[new] = judged[of]
            if len(self.known_pairs) + len(pairs) > MAX_PAIRS:
                self.known_pairs, self.known_fits = self.known_pairs[-1:], self.known_fits[-1:]
            at = np.searchsorted(self.known_pairs, pairs)
            self.known_pairs = np.insert(self.known_pairs, at, pairs)
            self.known_fits = np.insert(self.known_fits, at, judged)
        return fits

    def _longest(self, units: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The longest unit at a place of each row."""
        found = units[rows, at]                       # a character that no piece holds is its own
        node, live, step = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(live):
            letter = units[rows[live], at[live] + step]
            keys = np.where(letter < self.edge, node * self.edge + letter, -1)
            edge = np.searchsorted(self.step_keys, keys)
            met = self.step_keys[edge] == keys
            live, node, step = live[met], self.step_nodes[edge[met]].astype(np.int64), step + 1
            unit = self.unit_at[node]
            found[live[unit >= 0]] = unit[unit >= 0]
        return found

    def _split_rows(self, units: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Words by their characters, one in each row and ``edge`` behind it: their units by
        backtracking as in :meth:`split`, all words at once."""
        taken = np.full(units.shape, self.edge, np.int32)
        failed = np.zeros(units.shape, bool)
        at, depth = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        left = np.full(len(units), self.edge, np.int32)
        live = np.flatnonzero(sizes)
        unit = np.full(len(units), -1, np.int32)
        unit[live] = self._longest(units, live, at[live])
        while len(live):
            lost = live[unit[live] < 0]
            some = live[unit[live] >= 0]
            if len(lost):                             # no unit is left at the place
                failed[lost, at[lost]] = True
                depth[lost] -= 1
                last = taken[lost, depth[lost]]
                taken[lost, depth[lost]] = self.edge
                at[lost] -= self.size_of[last]
                left[lost] = np.where(depth[lost] > 0, taken[lost, depth[lost] - 1], self.edge)
                unit[lost] = self.shorter_of[last]
            end = at[some] + self.size_of[unit[some]]
            fits = ~failed[some, end]
            fits[fits] = self._fits(left[some[fits]], unit[some[fits]])
            unit[some[~fits]] = self.shorter_of[unit[some[~fits]]]
            some, end = some[fits], end[fits]
            taken[some, depth[some]] = left[some] = unit[some]
            depth[some] += 1
            at[some] = end
            some = some[end < sizes[some]]
            unit[some] = self._longest(units, some, at[some])
            live = live[at[live] < sizes[live]]
        return taken

    def split_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, how many of each), by backtracking."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        found: list[np.ndarray] = []
        counts = np.zeros(len(words), np.int64)
        at = 0
        for width in WIDTHS:
            end = int(np.searchsorted(sizes[order], width, side="right"))
            for start in range(at, end, COLUMNS):
                rows = order[start:min(end, start + COLUMNS)]
                units = np.full((len(rows), width + 1), self.edge, np.int32)
                units[np.arange(width + 1) < sizes[rows][:, None]] = self._characters([words[r] for r in rows])
                units = self._split_rows(units, sizes[rows])           # the edge has no ids
                counts[rows] = self.n_ids[units].sum(axis=1)
                flat = units[units != self.edge]
                found.append(self.ids_of[flat][np.arange(4) < self.n_ids[flat][:, None]])
            at = end
        for r in order[at:]:                                           # long words
            found.append(np.frombuffer(b"".join(map(self.word_ids, self.word.findall(
                words[r].replace(" ", MARK)))), np.int32))
            counts[r] = len(found[-1])
        flat = np.concatenate(found) if found else np.empty(0, np.int32)
        return flat[_spans((np.cumsum(counts[order]) - counts[order])[np.argsort(order)], counts)], counts

    def packed_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their ends beginning with 0): what :meth:`packed` gives for each."""
        if not self.by_word:
            ids = [self.packed(t) for t in texts]
            return np.concatenate([np.empty(0, np.int32), *ids]), np.cumsum([0, *map(len, ids)])
        first = " " if self.prefix else ""
        raw = [(first + t).replace(MARK, " ").encode() if t else b"" for t in texts]
        ends = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.zeros(len(data) + 1, bool)                         # a mark after none starts a word
        starts[:-1] = data == 32
        starts[1:-1] &= data[:-1] != 32
        starts[ends] = True
        cuts = np.flatnonzero(starts)
        words = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        coded = words.dictionary_encode()
        flat, counts = self.split_all(coded.dictionary.to_pylist())
        of = coded.indices.to_numpy()
        total = np.concatenate([[0], np.cumsum(counts[of])])
        return flat[_spans((np.cumsum(counts) - counts)[of], counts[of])], total[np.searchsorted(cuts, ends)]

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of the ids between neighbouring ends, as :meth:`decode` gives them."""
        raw = self.raw_pieces.take(pa.array(ids))
        at = np.concatenate([[0], np.cumsum(pc.binary_length(raw).to_numpy())])[ends].tolist()
        data = raw.buffers()[2] or b""
        texts = []
        for n, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            first = int(b > a and self.prefix and self.pieces[ids[ends[n]]].startswith(MARK))
            try:
                texts.append(str(memoryview(data)[a + first:b], "utf-8"))
            except UnicodeDecodeError:
                texts.append(self.decode(ids[ends[n]:ends[n + 1]].tolist()))
        return texts

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text as a list."""
        return self.packed(text).tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the prefix's space goes, bytes that are no UTF-8 become U+FFFD."""
        raw = self.raw
        first = int(bool(len(ids)) and self.prefix and self.pieces[ids[0]].startswith(MARK))
        joined = b"".join(map(raw.__getitem__, ids))[first:]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            pass
        text, run = [], b""
        for n, i in enumerate(ids):
            if self.is_byte[i]:
                run += raw[i]
                continue
            text += [_lenient(run), raw[i].decode()[first if n == 0 else 0:]]
            run = b""
        return "".join([*text, _lenient(run)])


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of spans, one span after another."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return np.repeat(shift, sizes) + np.arange(int(sizes.sum()))


def _lenient(run: bytes) -> str:
    """Every byte that starts no valid character becomes one U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    """The model of a file, once in every Python worker."""
    with open(path, "rb") as f:
        return PieceModel(f.read())


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded): whole texts encoded, and the ids decoded again.

    ``model_path`` names a file that every executor has (installed beside the library).
    Null and empty texts have no ids and decode to the empty text.  Texts of any length
    are read in one pass, without cutting; rows are independent, so repeated rows and
    ties need no rule, null ids stay null, and other columns, whatever their names, are
    not looked at.  An empty table gives an empty table.
    """
    load_model(model_path)                            # a file that does not fit is told here
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            ids, ends = model.packed_batch(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                 pa.array(model.decode_batch(ids, ends), pa.string())], names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, ids array<int>, decoded string")
