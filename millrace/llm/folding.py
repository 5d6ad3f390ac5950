"""Many texts as one array of base letters, with words and the way back.

A slice of texts is folded at once: marks and invisible characters vanish,
broken encodings are undone, Turkish letters become their base letters. Words
(runs of two or more Latin letters) get 64-bit hashes of their lower-case
letters, and so do their endings, from one running polynomial; no word becomes
a Python string.
"""

from __future__ import annotations

import unicodedata
from functools import cached_property

import numpy as np

_PLAIN = dict(zip(map(ord, "çğıöşüÇĞİÖŞÜâîûÂÎÛ’‘"), map(ord, "cgiosuCGIOSUaiuAIU''")))
_SAME = "“”–—…"
#: What a code point becomes: a code, or one of these.
_UNKNOWN, _MARK, _NOTHING, _MORE = -1, -2, -3, -4
_TABLE = np.full(0x10000, _UNKNOWN, np.int32)
_TABLE[:0x80] = np.arange(0x80)
for _c, _base in _PLAIN.items():
    _TABLE[_c] = _base
for _c in map(ord, _SAME):
    _TABLE[_c] = _c
_bases: dict[int, str] = {}

LETTER, UPPER, DIGIT, SPACE, ZONE = 1, 2, 4, 8, 16
_CLASS = np.zeros(0x3002, np.uint8)
for _c in range(0x3001):
    _CLASS[_c] = SPACE | ZONE if chr(_c).isspace() else 0
_CLASS[ord("a") : ord("z") + 1] = LETTER
_CLASS[ord("A") : ord("Z") + 1] = LETTER | UPPER
_CLASS[ord("0") : ord("9") + 1] = DIGIT | ZONE
for _c in "()+./‐–-":
    _CLASS[ord(_c)] |= ZONE

#: Letters of the endings that words are hashed by.
ENDINGS = (3, 4, 5, 6)
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_B, _B_INVERSE)):
            whole = np.full(max(n, 1 << 16), b, np.uint64)
            whole[0] = 1
            _powers[k] = np.cumprod(whole, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hash(word: str) -> int:
    """The hash that a word of lower-case Latin letters has in any text."""
    whole = 0
    for c in reversed(word):
        whole = (whole * int(_B) + ord(c)) & ((1 << 64) - 1)
    return int(_scramble(np.array([whole], np.uint64)).view(np.int64)[0])


def _base(c: int) -> str:
    """The letters that an unusual character stands for; cached by character."""
    if c not in _bases:
        parts = unicodedata.normalize("NFKD", chr(c))
        _bases[c] = "".join(p for p in parts if unicodedata.category(p)[0] != "M" and unicodedata.category(p) != "Cf").translate(_PLAIN)
    return _bases[c]


def _kind(c: int) -> int:
    base = _base(c)
    if len(base) == 1:
        return ord(base)
    return _MORE if base else _MARK if unicodedata.category(chr(c))[0] == "M" else _NOTHING


_pairs: dict[tuple[int, int], int | None] = {}


def _undo(a: int, b: int) -> int | None:
    """The letter whose two UTF-8 bytes were read as two characters of a one-byte code."""
    if (a, b) not in _pairs:
        try:
            raw = b"".join(c.encode("cp1252") if c not in "\x81\x8d\x8f\x90\x9d" else c.encode("latin1") for c in (chr(a), chr(b)))
            letter = raw.decode("utf-8")
            _pairs[a, b] = ord(letter) if len(letter) == 1 else None
        except UnicodeError:
            _pairs[a, b] = None
    return _pairs[a, b]


class Slice:
    """Several texts, folded.

    ``codes`` are the folded code points of all texts with a 0 between texts;
    ``bounds[i]:bounds[i + 1] - 1`` are those of text i. Places in text i are
    given by :meth:`span`.
    """

    def __init__(self, texts: list[str | None]):
        joined = "\0".join(t.replace("\0", " ") if t else "" for t in texts)
        source = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n_texts = len(texts)
        self.starts = self.ends = None
        if joined.isascii():
            self.codes = source
        else:
            self._fold(source)
        self.bounds = np.concatenate([[0], np.flatnonzero(self.codes == 0) + 1, [len(self.codes) + 1]])
        self.origin = self.bounds if self.starts is None else np.concatenate([[0], np.flatnonzero(source == 0) + 1, [len(source) + 1]])

    def _fold(self, source: np.ndarray) -> None:
        low = np.minimum(source, 0xFFFF)
        to = _TABLE[low]
        new = np.unique(low[to == _UNKNOWN])
        if len(new):
            for c in new[new < 0xFFFF].tolist():
                _TABLE[c] = _kind(c)
            to = _TABLE[low]
        high = np.flatnonzero(source >= 0xFFFF)
        if len(high):
            each, which = np.unique(source[high], return_inverse=True)
            to[high] = np.array([_kind(c) for c in each.tolist()], np.int32)[which]
        # bytes read as characters: "Ã¼" is one letter of two characters
        second: list[int] = []
        lead = np.flatnonzero((source[:-1] >= 0xC2) & (source[:-1] <= 0xC5) & (source[1:] >= 0x80))
        for p, a, b in zip(lead.tolist(), source[lead].tolist(), source[lead + 1].tolist()):
            letter = None if second and second[-1] == p else _undo(a, b)
            if letter is not None:
                kind = int(_TABLE[letter]) if letter < 0xFFFF and _TABLE[letter] != _UNKNOWN else _kind(letter)
                to[p], to[p + 1] = (kind, _MARK) if kind >= 0 else (_NOTHING, _NOTHING)
                second.append(p + 1)
        counts = (to >= 0).astype(np.int64)
        more = np.flatnonzero(to == _MORE)
        for p in more.tolist():
            counts[p] = len(_base(int(source[p])))
        at = np.repeat(np.arange(len(to)), counts)
        codes = to[at]
        for p in more.tolist():
            k = int(np.searchsorted(at, p))
            codes[k : k + counts[p]] = [ord(c) for c in _base(int(source[p]))]
        ends = at + 1
        marks = np.flatnonzero(to == _MARK)
        if len(marks):
            before = np.searchsorted(at, marks) - 1
            np.maximum.at(ends, before[before >= 0], marks[before >= 0] + 1)
        self.codes, self.starts, self.ends = codes.astype(np.uint32), at, ends

    @cached_property
    def folded(self) -> str:
        return self.codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")

    @cached_property
    def classes(self) -> np.ndarray:
        return _CLASS[np.minimum(self.codes, 0x3001)]

    def span(self, i: int, start: int, end: int) -> tuple[int, int]:
        """Places in text i of the folded places start..end of the slice."""
        o = int(self.origin[i])
        return (start - o, end - o) if self.starts is None else (int(self.starts[start]) - o, int(self.ends[end - 1]) - o)

    @cached_property
    def words(self) -> Words:
        return Words(self.codes)


class Words:
    """Runs of two or more letters: their places and hashes."""

    def __init__(self, codes: np.ndarray):
        cls = _CLASS[np.minimum(codes, 0x3001)]
        letter = (cls & LETTER).astype(bool)
        edge = np.flatnonzero(np.diff(letter.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
        start, end = edge[::2], edge[1::2]
        keep = end - start >= 2
        self.start, self.end = start[keep], end[keep]
        self.codes, self.classes = codes, cls
        n = len(codes) + 1
        power, inverse = _power(n)
        lower = np.where(letter, codes | 0x20, 0).astype(np.uint64)
        sums = np.empty(n, np.uint64)
        sums[0] = 0
        np.cumsum(lower * power[:-1], out=sums[1:])

        self._sums, self._inverse = sums, inverse
        self.hash = self._hashed(self.start, self.end)

    def _hashed(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return _scramble((self._sums[e] - self._sums[s]) * self._inverse[s]).view(np.int64)

    def endings(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the endings of some words, one row for each of ENDINGS; 0 where fewer than two letters would be left."""
        start, end = self.start[at], self.end[at]
        return np.stack([np.where(end - start >= k + 2, self._hashed(np.maximum(end - k, 0), end), 0) for k in ENDINGS])

    def without(self, spans: list[tuple[int, int]]) -> Words:
        """The words outside some spans, which count as no white space."""
        if not spans:
            return self
        codes = self.codes.copy()
        for a, b in spans:
            codes[a:b] = ord("|")
        out = object.__new__(Words)
        keep = codes[self.start] != ord("|")
        keep &= codes[self.end - 1] != ord("|")
        out.start, out.end, out.hash = self.start[keep], self.end[keep], self.hash[keep]
        out.codes, out.classes, out._sums, out._inverse = codes, _CLASS[np.minimum(codes, 0x3001)], self._sums, self._inverse
        return out

    def __len__(self) -> int:
        return len(self.start)

    @cached_property
    def upper(self) -> np.ndarray:
        """Whether a word begins with a capital letter."""
        return (self.classes[self.start] & UPPER).astype(bool)

    @cached_property
    def gap(self) -> np.ndarray:
        """Characters between a word and the next."""
        return self.start[1:] - self.end[:-1]

    def spaced(self, comma: bool = False, most: int = 4) -> np.ndarray:
        """Whether only white space (a comma and white space) of up to ``most`` characters and one line end lies between a word and the next."""
        if len(self.start) < 2:
            return np.zeros(0, bool)
        e, s = self.end[:-1] + comma, self.start[1:]
        ok = (self.gap <= most) & (s > e)
        if comma:
            ok &= self.codes[self.end[:-1]] == ord(",")
        lines = np.zeros(len(ok), np.int8)
        last = len(self.codes) - 1
        for k in range(most):
            at = np.minimum(e + k, last)
            inside = e + k < s
            ok &= ~inside | ((self.classes[at] & SPACE) > 0)
            lines += inside & (self.codes[at] == 10)
        return ok & (lines < 2)

    def at(self, place: int) -> int:
        """The word that starts at a place, or -1."""
        k = int(np.searchsorted(self.start, place))
        return k if k < len(self.start) and self.start[k] == place else -1
