"""Personal data that has a form: e-mail addresses, phone and identity numbers, street addresses.

Forms are matched only where their rarest part stands (an @ or a spelled one, a
zone with enough digits, a road word), so that a text is not walked through once
for each pattern. A number's form alone doesn't say what it numbers; such
candidates carry the words before them, and how much these disclose is
estimated from the corpus (see millrace.llm.pii).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import xxhash

from millrace.llm.folding import DIGIT, ZONE, Slice, word_hash

# Forms of the kinds, on folded text.
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_LOCAL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?"
_BRACKETED_DOT = r"\s*[\[({]\s*(?:dot|nokta|\.)\s*[\])}]\s*"
_DOT = rf"(?:\.|{_BRACKETED_DOT}|\s(?:dot|nokta)\s)"
_AT = r"(?:\s{0,2}@\s{0,2}|\s*[\[({]\s*(?:at|et|a|@)\s*[\])}]\s*|\s(?:at|et)\s)"
EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+-]){_LOCAL}(?P<at>{_AT})(?P<domain>{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}(?P<last>[A-Za-z]{{2,}}))(?![A-Za-z0-9])", re.I)
#: A sign in brackets, as in "(at)".
_BRACKETED = re.compile(r"[\[({]\s*(?:at|et|a|@)\s*[\])}]", re.I)
_SPELLED_DOT = re.compile(r"dot|nokta", re.I)
#: Endings of file names (fixed values).
FILE_ENDINGS = frozenset("png jpg jpeg gif webp svg bmp tif tiff ico pdf css js json csv txt py html htm xml zip gz mp3 mp4 avi mov doc docx xls xlsx ppt pptx".split())

_SEP = r"(?:[^\S\n]{1,2}|\n|[./‐–-])"
_S = f"{_SEP}?"
PHONE = re.compile(
    rf"(?<![\dA-Za-z+])(?<!\d[.,/-])(?:"
    rf"(?:(?:(?:\+|00)90{_S}|0{_S})(?:\([2-58]\d\d\)|[2-58]\d\d){_S}|\([2-58]\d\d\){_S}|[2-58]\d\d{_SEP})\d{{3}}{_S}\d\d{_S}\d\d|5\d{{9}}"
    rf"|(?:(?:\+|00)44{_S}(?:\(0\){_S})?|0)(?:7\d{{3}}{_S}\d{{3}}{_S}\d{{3}}|20{_S}\d{{4}}{_S}\d{{4}}|1\d\d{_S}\d{{3}}{_S}\d{{4}}|1\d{{3}}{_S}\d{{3}}{_S}\d{{3}})"
    rf"|(?:\+?1{_S})?(?:\([2-9]\d\d\)|[2-9]\d\d)(?:\s{{1,2}}|[./‐–-])\d{{3}}(?:\s{{1,2}}|[.‐–-])\d{{4}}|\(020\)\s?\d{{4}}\s?\d{{4}}"
    rf")(?!\d)"
)
TR_ID = re.compile(r"(?<![\dA-Za-z])(?<!\d[.,/-])[1-9](?:\d{10}|\d\d(\s{1,2}|[.‐–-])\d{3}\1\d{3}\1\d\d|\d{4}(?:\s{1,2}|[.‐–-])\d{6}|\d\d(\s{1,2}|[.‐–-])\d{4}\2\d{4})(?![\dA-Za-z])(?![.,/-]\d)")
UK_ID = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}(\s{1,2}|[‐–-]|)\d\d\1\d\d\1\d\d\1[A-Da-d](?![A-Za-z0-9])")
#: Words that announce numbers of other kinds, phone numbers and identity numbers: what is expected before the corpus is known (fixed values).
OTHER_WORDS = frozenset("fatura takip siparis kargo hesap iban isbn barkod seri stok sicil dosya order invoice tracking account parcel serial book".split())
PHONE_WORDS = frozenset("tel telefon gsm cep faks fax phone mobile call whatsapp ararsaniz arayin hatti line numara".split())
ID_WORDS = frozenset("tc tckn kimlik ni insurance nino".split())

_WORD = r"[A-Za-z]{2,}"
_CAP = r"(?-i:[A-Z][A-Za-z]+)"
_NUMBER = r"(?:\s*,?\s*(?:no|numara)\s*[.:]?\s*:?\s*\d+[A-Za-z]?(?:\s?/\s?\d+[A-Za-z]?)?|\s+\d+[A-Za-z]?(?:/\d+[A-Za-z]?)?)(?![\d])"
_FLAT = r"(?:\s*,?\s*(?:daire|kat|d|k|ic kapi)\s*(?:no)?\s*[.:]\s*\d+)*"
_TOWN = rf"(?:,?\s{{1,3}}\d{{5}}\s{{1,2}}{_CAP}(?:[ \t]*/[ \t]*{_CAP})?|,\s{{0,2}}{_CAP}(?:[ \t]*/[ \t]*{_CAP})?|[ \t]+(?-i:[A-Z][a-z]+)(?:[ \t]*/[ \t]*{_CAP})?)?"
_QUARTERS, _STREETS = "mahallesi mah mh", "sokagi sokak sok sk caddesi cadde cad cd bulvari bulvar bulv blv"
_ROADS = "Street Road Lane Avenue Close Drive Way Court Place Terrace Square Crescent Gardens Row St Rd Ave Ln"


_SHORT = frozenset("mah mh sok sk cad cd bulv blv St Rd Ave Ln".split())


def _any(words: str) -> str:
    """Any of the road words; short forms may have a point."""
    return "(?:" + "|".join(rf"{w}\b\.?" if w in _SHORT else w for w in words.split()) + ")"


_QUARTER = rf"{_WORD}\s{{1,2}}{_any(_QUARTERS)}"
_STREET = rf"(?:{_WORD}|\d+\.)\s{{1,2}}{_any(_STREETS)}"
TR_ADDRESS = re.compile(rf"\b(?:{_QUARTER},?\s+(?:{_STREET},?)?|{_STREET},?){_NUMBER}{_FLAT}{_TOWN}", re.I)
_UNIT = r"(?:Flat|Apartment|Apt\.?|Unit)"
UK_ADDRESS = re.compile(rf"\b(?:{_UNIT}\s{{1,2}}\d+[A-Za-z]?,?\s{{1,2}})?\d+[A-Za-z]?\s{{1,2}}(?:{_CAP}\s{{1,2}}){{1,2}}{_any(_ROADS)}(?:,\s{{1,2}}{_UNIT}\s{{1,2}}\d+[A-Za-z]?)?(?:,\s{{1,2}}{_CAP}(?:\s(?-i:[A-Z]{{1,2}}\d[A-Z\d]?\s?\d[A-Z]{{2}}))?|,\s(?-i:[A-Z]{{1,2}}\d[A-Z\d]?\s?\d[A-Z]{{2}}))?", re.I)
_BEFORE_ROAD = re.compile(r"(?:[A-Za-z]{2,}|\d+\.)\s{1,2}\Z")


def _hashes(words: str) -> np.ndarray:
    return np.array(sorted({word_hash(w.lower()) for w in words.split()}), np.int64)


_TR_ROAD_WORDS, _UK_ROAD_WORDS = _hashes(f"{_QUARTERS} {_STREETS}"), _hashes(_ROADS)


def among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which values are in a sorted list."""
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def tr_id_holds(digits: str) -> bool:
    """Check digits of a Turkish identity number."""
    d = [int(c) for c in digits]
    return len(d) == 11 and d[0] != 0 and (7 * sum(d[0:9:2]) - sum(d[1:8:2])) % 10 == d[9] and sum(d[:10]) % 10 == d[10]


#: The number has more groups than those matched.
_GOES_ON = re.compile(r"[.,/‐–-]\d")
EMAIL_KIND, ID_KIND, PHONE_KIND, ADDRESS_KIND = range(4)
KINDS = ("email", "id_number", "phone", "address")


class Candidate(NamedTuple):
    """Folded places, the kind, what its form alone makes it worth (1: enough), and the words before it."""

    start: int
    end: int
    kind: int
    prior: float
    both: int  # hash of the two words before it
    last: int  # hash of the word before it


class Context(NamedTuple):
    """A number that the corpus is asked about: the kind in question, the words before it, and whether its form is the kind's."""

    kind: int
    both: int
    last: int
    holds: bool


def _before(folded: str, lo: int, at: int) -> list[str]:
    """Up to three words before a place, in the same clause."""
    held = re.split(r"[\n;|]", folded[max(lo, at - 40) : at].rstrip())[-1]
    return re.findall(r"[A-Za-z]{2,}", held.lower())[-3:]


def _keys(words: list[str]) -> tuple[int, int]:
    def key(w: list[str]) -> int:
        return xxhash.xxh64_intdigest(" ".join(w)) - (1 << 63) if w else 0

    return key(words[-2:]) if len(words) > 1 else 0, key(words[-1:])


def _emails(s: Slice) -> Iterator[Candidate]:
    places = [np.flatnonzero(s.codes == ord("@"))]
    lower = s.folded.lower()
    for word in ("nokta", "dot"):
        at = lower.find(word)
        while at >= 0:
            places.append(np.array([at]))
            at = lower.find(word, at + 1)
    brackets = np.flatnonzero((s.codes == ord("(")) | (s.codes == ord("[")) | (s.codes == ord("{")))
    if len(brackets):
        inside = s.codes[np.minimum(brackets + 1, len(s.codes) - 1)] | 0x20
        places.append(brackets[np.isin(inside, [ord("a"), ord("e"), 0x60, 0x20 | ord(" "), ord("\n") | 0x20])])
    docs = np.unique(np.searchsorted(s.bounds, np.concatenate(places), "right") - 1)
    for i in docs.tolist():
        lo, hi = int(s.bounds[i]), int(s.bounds[i + 1]) - 1
        if "@" not in s.folded[lo:hi] and not _SPELLED_DOT.search(s.folded, lo, hi) and not _BRACKETED.search(s.folded, lo, hi):
            continue
        for m in EMAIL.finditer(s.folded, lo, hi):
            spelled = m["at"].strip().lower()
            dotted = _SPELLED_DOT.search(m["domain"])
            if m["last"].lower() in FILE_ENDINGS or not dotted and (spelled in ("at", "et") or spelled == "@" and "." not in m["domain"]):
                continue
            yield Candidate(m.start(), m.end(), EMAIL_KIND, 1.0, 0, 0)


def _zones(s: Slice) -> Iterator[tuple[int, int, int]]:
    """Runs of digits and what stands between groups of digits, with the number of digits (six or more)."""
    cls = s.classes
    inside = ((cls & ZONE) > 0).astype(np.int8)
    edge = np.flatnonzero(np.diff(inside, prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    digits = np.concatenate([[0], np.cumsum((cls & DIGIT) > 0)])
    n = digits[end] - digits[start]
    keep = n >= 6
    return zip(start[keep].tolist(), end[keep].tolist(), n[keep].tolist())


def _numbers(s: Slice) -> tuple[list[Candidate], list[Context]]:
    """Identity and phone numbers, and what each number says about the words before it."""
    folded, found, told = s.folded, [], []
    for start, end, digits in _zones(s):
        lo = int(s.bounds[np.searchsorted(s.bounds, start, "right") - 1])
        stop = min(end + 2, len(folded))
        if digits >= 11:
            for m in TR_ID.finditer(folded, start, stop):
                words = _before(folded, lo, m.start())
                both, last = _keys(words)
                holds = tr_id_holds(re.sub(r"\D", "", m[0]))
                told.append(Context(ID_KIND, both, last, holds))
                if holds:
                    found.append(Candidate(m.start(), m.end(), ID_KIND, 0.1 if OTHER_WORDS & set(words) else 0.9, both, last))
        for m in UK_ID.finditer(folded, max(lo, start - 3), stop):
            words = _before(folded, lo, m.start())
            both, last = _keys(words)
            holds = m[0][:2].isupper()
            told.append(Context(ID_KIND, both, last, holds))
            found.append(Candidate(m.start(), m.end(), ID_KIND, 0.9 if holds or ID_WORDS & set(words) else 0.1, both, last))
        seen = False
        if digits >= 10:
            for m in PHONE.finditer(folded, start, stop):
                words = _before(folded, lo, m.start())
                both, last = _keys(words)
                bare = m[0].isdigit() and len(m[0]) == 10
                told.append(Context(PHONE_KIND, both, last, not bare and not _GOES_ON.match(folded, m.end(), stop)))
                announced = bool(PHONE_WORDS & set(words))
                other = bool(OTHER_WORDS & set(words)) and words[-1] not in PHONE_WORDS
                found.append(Candidate(m.start(), m.end(), PHONE_KIND, 0.1 if other or bare and not announced else 0.9, both, last))
                seen = True
        if digits >= 9 and not seen:
            told.append(Context(PHONE_KIND, *_keys(_before(folded, lo, start)), False))
    return found, told


def _addresses(s: Slice) -> Iterator[Candidate]:
    folded, words = s.folded, s.words
    free = 0
    for k in np.flatnonzero(among(words.hash, _TR_ROAD_WORDS)).tolist():
        place = int(words.start[k])
        i = int(np.searchsorted(s.bounds, place, "right")) - 1
        lo, hi = int(s.bounds[i]), int(s.bounds[i + 1]) - 1
        # the word or number before the road word
        if k and place - words.end[k - 1] <= 2 and folded[words.end[k - 1] : place].isspace():
            start = int(words.start[k - 1])
        else:
            head = _BEFORE_ROAD.search(folded, max(lo, place - 12), place)
            if not head:
                continue
            start = head.start()
        if start < free:
            continue
        m = TR_ADDRESS.match(folded, start, hi)
        if m:
            free = m.end()
            yield Candidate(m.start(), m.end(), ADDRESS_KIND, 1.0, 0, 0)
    if not len(words):
        return
    road = among(words.hash, _UK_ROAD_WORDS)
    road[0] = False
    road[1:] &= words.upper[:-1] & (words.gap <= 2)
    free = 0
    for k in np.flatnonzero(road).tolist():
        place = int(words.start[k])
        i = int(np.searchsorted(s.bounds, place, "right")) - 1
        lo, hi = int(s.bounds[i]), int(s.bounds[i + 1]) - 1
        # a house number stands before one or two names; a flat before that
        m = UK_ADDRESS.search(folded, max(lo, free, place - 80), hi) if re.search(r"\d", folded[max(lo, place - 60) : place]) else None
        while m and m.end() < place:
            m = UK_ADDRESS.search(folded, m.end(), hi)
        if m and m.start() < place and m.start() >= free:
            free = m.end()
            yield Candidate(m.start(), m.end(), ADDRESS_KIND, 1.0, 0, 0)


def candidates(s: Slice) -> tuple[list[Candidate], list[Context]]:
    """Candidates of all kinds in the order in which they take precedence, and what the numbers tell about their contexts."""
    numbers, told = _numbers(s)
    numbers.sort(key=lambda c: (c.kind, c.start))
    return [*_emails(s), *numbers, *_addresses(s)], told
