"""Personal information in free text, found and replaced by typed placeholders.

Information-theoretic sanitisation: how strongly a term reveals a protected
entity is estimated from its co-occurrences in the whole corpus, and terms that
disclose enough are replaced. The terms are of two sorts.

Words before a number. The form of a phone or identity number doesn't say what
it numbers. Of all numbers after the same one or two words, the share whose
form is the kind's (check digits, grouping) is what these words disclose;
shares of rare words lean on those of the shorter context, and these on what
the form alone is worth. Invoice or book numbers fail by their context.
E-mail and street addresses disclose by their form alone.

Words of names. Words that stand where a person is announced ("Sayin ...",
"Written by: ...") are counted together with all occurrences of the same words
and with the partners they stand beside. A given name, and a surname or its
ending, is disclosive if the word and a person's place have positive pointwise
mutual information, if the word discloses the place with a high share of its
occurrences, and if its partners are many - a title of an office is
always the same two words, a given name stands beside many surnames. Runs of
disclosive given names and surnames are mentions wherever they stand, in either
order and any case. Where a person is announced, capital words are a mention if
both disclose that place, however rare they are.

Texts are read once: one pass folds them (millrace.llm.folding), matches forms,
and counts words, pairs and contexts by 64-bit hashes. It deals the documents
into blocks of bounded size as they are read, and keeps candidates beside the
texts. The disclosive terms stay a table, of any length; a block gets the
shares of its own words only, and decides.

Results: null and empty texts have no mention, and stay as they are; a mention
that repeats in a document is one row; kinds take precedence in the order
e-mail, identity number, phone, address, name, and none overlaps an earlier one.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.folding import ENDINGS, Slice, Words, word_hash
from millrace.llm.forms import ID_KIND, KINDS, PHONE_KIND, Candidate, among, candidates
from millrace.storage import materialize, spread

#: Code points of the documents in one block, about (a longer document is a block of its own).
BLOCK_CHARS = 1_500_000
GIVEN, SURNAME, ENDING, FIRST, LAST, BOTH_WORDS, LAST_WORD = range(7)
#: Share of a word's occurrences that stand at a person's place, for a given name (it may be a common word too), for a surname, and the product of both for a mention.
GIVEN_SHARE, LAST_SHARE, MENTION_SHARE = 0.004, 0.13, 0.0008
#: Different partners that a term has at least, and those of a whole surname.
PARTNERS, SURNAME_PARTNERS = 2, 3
#: Numbers that the shorter context weighs as much as, and the share from which a number is the kind's.
LEANING, NUMBER_SHARE = 2.0, 0.5

# Names. Phrases that announce a person (fixed values).
_BEFORE = (
    r"(?:\b(?:sayin|sn\.|bay|bayan|dr\.?|prof\.?|doc\.?|av\.?|uzm\.?|ogr\.? gor\.?|muh\.?|mr\.?|mrs\.?|ms\.?|miss|sir|adim|komsumuz|my name is|contact person is|kept by|thanks to|merhaba, ben)"
    r"|\b(?:ad soyad|adi soyadi|isim|yazan|yazar|hazirlayan|ceviren|basvuran|imza|ilgili kisi|written by|author|name|signed|contact)\s?:"
    r"|\b(?:saygilarimla|sevgiler|sevgilerimle|kind regards|best regards|regards|sincerely|yours)\s?,)\s{1,3}"
)
#: The first words of these phrases.
_CUES = np.array(sorted(map(word_hash, "sayin sn bay bayan dr prof doc av uzm ogr muh mr mrs ms miss sir adim komsumuz my contact kept thanks merhaba ad adi isim yazan yazar hazirlayan ceviren basvuran imza ilgili written author name signed saygilarimla sevgiler sevgilerimle kind best regards sincerely yours".split())), np.int64)
_NAME_WORD = r"[A-Za-z]{2,}"
#: Kinds of places, bodies, roads, buildings and offices (fixed values).
NOT_PERSONS = frozenset(
    "merkezi meclisi mudurlugu belediyesi vakfi kooperatifi dernegi kulubu enstitusu mahallesi mah mh sokak sokagi sok sk caddesi cad cd bulvari parki ilkokulu ortaokulu lisesi okulu koprusu hastanesi universitesi fakultesi camii muzesi"
    " apartmani sitesi meydani hani kosku oteli stadyumu havalimani gari istasyonu iskelesi baraji golu dagi vadisi koyu kurul kurulu uyeleri uyesi yetkili yetkilisi muduru baskan baskani vekili kurum kurumu okur okurlar veliler veli haber"
    " sirketi bankasi gazetesi dergisi odasi birligi sendikasi bakanligi valiligi kaymakamligi muhtarligi baskanligi"
    " street road lane avenue close drive way court place terrace square hall society council institute bridge park school college university hospital house committee association club museum library church station board editor team office department madam".split()
)
_NOUNS = np.array(sorted(map(word_hash, NOT_PERSONS)), np.int64)
SEED = re.compile(_BEFORE, re.I)
SEED_A = re.compile(rf"(?P<run>{_NAME_WORD}\s{{1,2}}{_NAME_WORD}(?:[ \t]{{1,2}}{_NAME_WORD})?(?:-{_NAME_WORD})?)", re.I)
SEED_B = re.compile(rf"(?P<last>{_NAME_WORD}(?:-{_NAME_WORD})?),\s{{1,2}}(?P<first>{_NAME_WORD})", re.I)


def announced(folded: str, words: Words) -> Iterator[re.Match]:
    """Words that may be a name after a phrase that announces a person: matches of SEED_B where it fits, else of SEED_A."""
    free = 0
    for place in words.start[among(words.hash, _CUES)].tolist():
        m = SEED.match(folded, place) if place >= free else None
        if m:
            free = m.end()
            found = SEED_B.match(folded, free) or SEED_A.match(folded, free)
            if found:
                yield found


def name_pairs(folded: str, words: Words) -> Iterator[tuple[int, int]]:
    """(first, last): places among ``words`` of those that might be a given name and a surname where a person is announced."""
    for m in announced(folded, words):
        if m.re is SEED_B:
            yield words.at(m.start("first")), words.at(m.start("last"))
            continue
        at = [words.at(m.start("run") + x.start()) for x in re.finditer(r"\S+", m["run"])]
        upper = words.upper[at]
        # the run may reach past the name: a third word counts if it is written like the second
        if len(at) == 3 and (upper[2] or not upper[1] and not upper[0]):
            yield at[1], at[2]
            yield at[0], at[2]
            if not upper[2]:
                yield at[0], at[1]
        else:
            yield at[0], at[1]


def _grouped(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and the sums of their weights."""
    if not len(weights):
        return columns, weights
    order = np.lexsort(columns[::-1])
    rows = [c[order] for c in columns]
    new = np.append(True, np.any([r[1:] != r[:-1] for r in rows], axis=0))
    return [r[new] for r in rows], np.add.reduceat(weights[order], np.flatnonzero(new))


DOCUMENT, TERM, PAIR, CONTEXT = range(4)
_READ = "part tinyint, block bigint, a bigint, b bigint, kind int, e3 bigint, e4 bigint, e5 bigint, e6 bigint, n bigint, held bigint, text string, spans binary"
_SPAN = np.dtype([("start", "<i4"), ("end", "<i4"), ("kind", "<i4"), ("prior", "<f4"), ("both", "<i8"), ("last", "<i8")])


def _read(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> all that one pass over the texts finds.

    Rows are, by ``part``: documents with their candidates in ``spans``; the
    distinct words of each block (a: word, e3..e6: endings) and how often they
    stand there; pairs (a, b, kind: 1 if announced, e3..e6: endings of b);
    contexts of numbers (a: both words, b: the last, n: numbers, held: those
    of the kind's form).
    """
    id_type = docs.schema["doc_id"].dataType
    schema = f"{_READ}, doc_id {id_type.simpleString()}"
    names = [c.split()[0] for c in _READ.split(", ")]

    def rows_of(part: int, ids: pa.DataType, size: int, **columns) -> pa.RecordBatch:
        types = {"part": pa.int8(), "kind": pa.int32(), "text": pa.string(), "spans": pa.binary(), "doc_id": ids}
        arrays = []
        for c in [*names, "doc_id"]:
            given = pa.array(np.full(size, part, np.int8)) if c == "part" else columns.get(c)
            kind = types.get(c, pa.int64())
            arrays.append(pa.nulls(size, kind) if given is None else given if isinstance(given, pa.Array) else pa.array(given, kind))
        return pa.RecordBatch.from_arrays(arrays, [*names, "doc_id"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in it:
            texts, ids = batch.column(1).to_pylist(), batch.column(0).type
            for lo, hi in _portions(texts):
                s = Slice(texts[lo:hi])
                found, told = candidates(s)
                spans: list[list[tuple]] = [[] for _ in range(hi - lo)]
                bounds = s.bounds.tolist()
                for c in found:
                    i = bisect_right(bounds, c.start) - 1
                    spans[i].append((c.start - bounds[i], c.end - bounds[i], *c[2:]))
                yield rows_of(DOCUMENT, ids, hi - lo, block=np.full(hi - lo, block), text=batch.column(1).slice(lo, hi - lo), spans=[np.array(x, _SPAN).tobytes() if x else None for x in spans], doc_id=batch.column(0).slice(lo, hi - lo))
                words = s.words.without([c[:2] for c in found])
                if len(words):
                    each, first, n = np.unique(words.hash, return_index=True, return_counts=True)
                    yield rows_of(TERM, ids, len(each), block=np.full(len(each), block), a=each, n=n, **dict(zip(_ENDS, words.endings(first))))
                    pairs = np.array(list(name_pairs(s.folded, words)), np.int64).reshape(-1, 2)
                    beside = np.flatnonzero(words.upper[:-1] & words.upper[1:] & words.spaced(most=1))
                    first, last = np.concatenate([pairs[:, 0], beside]), np.concatenate([pairs[:, 1], beside + 1])
                    kind = np.repeat([1, 0], [len(pairs), len(beside)])
                    keep = ~(among(words.hash[first], _NOUNS) | among(words.hash[last], _NOUNS))
                    first, last, kind = first[keep], last[keep], kind[keep]
                    columns, n = _grouped([words.hash[first], words.hash[last], kind, *words.endings(last)], np.ones(len(first), np.int64))
                    yield rows_of(PAIR, ids, len(n), a=columns[0], b=columns[1], kind=columns[2], n=n, **dict(zip(_ENDS, columns[3:])))
                if told:
                    counted, held = Counter((c.both, c.last, c.kind) for c in told), Counter((c.both, c.last, c.kind) for c in told if c.holds)
                    rows = list(counted)
                    yield rows_of(CONTEXT, ids, len(rows), a=[r[0] for r in rows], b=[r[1] for r in rows], kind=[r[2] for r in rows], n=list(counted.values()), held=[held[r] for r in rows])
                block += 1

    return docs.mapInArrow(run, schema)


def _portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, t in enumerate(texts):
        n = len(t) + 1 if t else 1
        if held and held + n > BLOCK_CHARS:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


_ENDS = [f"e{k}" for k in ENDINGS]


def _ends() -> Column:
    """The endings of a row's word that leave at least two letters before them."""
    return F.filter(F.array(*_ends_columns()), lambda x: x != 0)


def _ends_columns() -> list[Column]:
    return [F.col(c) for c in _ENDS]


def disclosive(read: DataFrame) -> DataFrame:
    """(role, term, share, n): what the corpus of ``read`` says of its words.

    Given names, surnames and surname endings with the share of occurrences by
    which each discloses a person; the same of words in announced pairs,
    however few (FIRST, LAST); and of the words before numbers the share that
    has the form of a kind (BOTH_WORDS and LAST_WORD, plus ten times the kind).
    """
    schema = "role int, term bigint, share double, n bigint"
    spark = read.sparkSession
    terms = materialize(read.filter(F.col("part") == TERM).groupBy(F.col("a").alias("term"), *_ENDS).agg(F.sum("n").alias("n")), "vocabulary")
    pairs = materialize(read.filter(F.col("part") == PAIR).groupBy("a", "b", "kind", *_ENDS).agg(F.sum("n").alias("n")), "pairs")
    occurrences = terms.select("term", F.col("n").alias("all"))
    endings_all = terms.select(F.explode(_ends()).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("all"))
    contexts = read.filter((F.col("part") == CONTEXT)).groupBy("a", "b", "kind").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))
    told = [
        contexts.filter(F.col(c) != 0).groupBy((F.col("kind") * 10 + role).alias("role"), F.col(c).alias("term")).agg((F.sum("held") / F.sum("n")).alias("share"), F.sum("n").alias("n"))
        for role, c in ((BOTH_WORDS, "a"), (LAST_WORD, "b"))
    ]
    numbers = told[0].unionByName(told[1])
    none = F.lit(None).cast("bigint")
    both = terms.select(F.col("n").alias("words"), none.alias("announced")).unionByName(pairs.filter("kind = 1").select(none.alias("words"), F.col("n").alias("announced")))
    sums = both.agg(F.sum("words").alias("words"), F.sum("announced").alias("announced")).first()
    if not sums["words"] or not sums["announced"]:
        return materialize(numbers, "lexicon")

    def shares(rows: DataFrame, known: DataFrame) -> DataFrame:
        """(term, share, a, d) of (term, partner, n): share of occurrences, occurrences beside a partner, and partners."""
        beside = rows.groupBy("term", "partner").agg(F.sum("n").alias("n")).groupBy("term").agg(F.sum("n").alias("a"), F.count(F.lit(1)).alias("d"))
        return beside.join(known, "term").withColumn("share", F.least(F.lit(1.0), F.col("a") / F.col("all")))

    def strong(scored: DataFrame, total: int, least: float, partners: int) -> DataFrame:
        """Terms with enough partners, a share of at least ``least`` and positive mutual information with a person's place."""
        pmi = F.log(F.col("share")) - math.log(total / sums["words"])
        return scored.filter((F.col("d") >= partners) & (F.col("share") >= least) & (pmi > 0)).select("term", "share", "a")

    def by_ending(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(_ends()).alias("term"), F.col("a").alias("partner"), "n")

    of_first = lambda rows: rows.select(F.col("a").alias("term"), F.col("b").alias("partner"), "n")
    of_last = lambda rows: rows.select(F.col("b").alias("term"), F.col("a").alias("partner"), "n")
    told_pairs = pairs.filter("kind = 1")
    endings = strong(shares(by_ending(told_pairs), endings_all), sums["announced"], LAST_SHARE, PARTNERS)
    # a second look with every pair whose surname has a disclosive ending, announced or not
    either = pairs.groupBy("a", "b", *_ENDS).agg(F.max("n").alias("n"))
    ended = either.withColumn("_e", F.explode(_ends())).join(endings.select(F.col("term").alias("_e")), "_e", "left_semi").groupBy("a", "b", *_ENDS).agg(F.max("n").alias("n"))
    seen = materialize(ended, "seeds")
    total = seen.agg(F.sum("n")).first()[0] or 0
    rare = shares(of_first(told_pairs), occurrences).select(F.lit(FIRST).alias("role"), "term", "share", F.col("a").alias("n")).unionByName(shares(of_last(told_pairs), occurrences).select(F.lit(LAST).alias("role"), "term", "share", F.col("a").alias("n")))
    if not total:
        return materialize(numbers.unionByName(rare), "lexicon")
    with_role = lambda df, role: df.select(F.lit(role).alias("role"), df["term"], "share", F.col("a").alias("n"))
    lasting = strong(shares(by_ending(seen), endings_all), total, LAST_SHARE, PARTNERS)
    surnames = strong(shares(of_last(seen), occurrences), total, LAST_SHARE, SURNAME_PARTNERS)
    given = materialize(strong(shares(of_first(seen), occurrences), total, GIVEN_SHARE, PARTNERS), "given")
    # a word that stands before given names more often than before surnames announces persons and isn't a name
    before = either.join(given.select(F.col("term").alias("g")), F.col("b") == F.col("g"), "left_semi").groupBy(F.col("a").alias("f")).agg(F.sum("n").alias("before"))
    given = given.join(before, F.col("term") == F.col("f"), "left").filter(F.coalesce("before", F.lit(0)) < F.col("a"))
    whole = with_role(given, GIVEN).unionByName(with_role(surnames, SURNAME)).unionByName(with_role(lasting, ENDING)).unionByName(rare).unionByName(numbers)
    return materialize(whole.select([F.col(f.split()[0]).cast(f.split()[1]) for f in schema.split(", ")]), "lexicon")


class Shares:
    """A lookup of shares (and counts) by term."""

    def __init__(self, terms: np.ndarray, shares: np.ndarray, counts: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.terms, self.values, self.counts = terms[order], shares[order], counts[order]

    def of(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(terms))
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, self.values[at], 0.0)

    def one(self, term: int) -> tuple[float, int]:
        at = int(np.searchsorted(self.terms, term))
        return (float(self.values[at]), int(self.counts[at])) if at < len(self.terms) and self.terms[at] == term else (0.0, 0)


class Lexicon:
    """The disclosive terms among the words of one block."""

    def __init__(self, roles: np.ndarray, terms: np.ndarray, shares: np.ndarray, counts: np.ndarray):
        self.roles = {r: Shares(terms[roles == r], shares[roles == r], counts[roles == r]) for r in np.unique(roles).tolist()}
        self.none = Shares(np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))

    def __getitem__(self, role: int) -> Shares:
        return self.roles.get(role, self.none)

    def number_share(self, c: Candidate) -> float:
        """How strongly the words before a number disclose its kind."""
        share = c.prior
        if c.kind in (ID_KIND, PHONE_KIND):
            for role, term in ((LAST_WORD, c.last), (BOTH_WORDS, c.both)):
                told, n = self[c.kind * 10 + role].one(term)
                share = (told * n + LEANING * share) / (n + LEANING)
        return share


class Names:
    """Runs of disclosive given names and surnames in a slice, with double names as one word."""

    def __init__(self, folded: str, w: Words, lexicon: Lexicon):
        self.folded, self.words, self.lexicon = folded, w, lexicon
        n = len(w)
        given = lexicon[GIVEN].of(w.hash)
        # words that may be surnames stand near given names or announcing words
        near = (given > 0) | among(w.hash, _CUES)
        for _ in range(3):
            near = near | np.append(near[1:], False) | np.append(False, near[:-1])
        near |= np.append(np.zeros(4, bool), near[:-4])[:n]
        at = np.flatnonzero(near)
        single = np.zeros(n)
        single[at] = lexicon[SURNAME].of(w.hash[at])
        for e in w.endings(at):
            single[at] = np.maximum(single[at], lexicon[ENDING].of(e))
        self.single = single
        # "a-b" is one word, "a-b-c" two
        tied = np.zeros(n, bool)
        tied[:-1] = (w.gap == 1) & (w.codes[w.end[:-1]] == ord("-")) if n > 1 else False
        second = np.zeros(n, bool)
        for i in np.flatnonzero(tied).tolist():
            if not second[i]:
                second[i + 1] = True
        first = np.flatnonzero(~second)
        double = np.zeros(n, bool)
        double[:-1] = second[1:]
        self.double = double[first]
        partner = np.minimum(first + self.double, max(n - 1, 0))
        self.start, self.end = w.start[first], w.end[partner]
        self.share = np.where(self.double, np.minimum(single[first], single[partner]), single[first])
        self.given = np.where(self.double, 0.0, given[first])
        self.noun = ~self.double & among(w.hash[first], _NOUNS)
        self.place = np.full(n, -1)
        self.place[first] = np.arange(len(first))
        space = np.zeros(len(first), bool)
        comma = np.zeros(len(first), bool)
        if len(first) > 1:
            lie, lie_comma = w.spaced(), w.spaced(comma=True)
            space[:-1], comma[:-1] = lie[partner[:-1]], lie_comma[partner[:-1]]
        self.joined, self.comma = space, comma

    def find(self) -> list[tuple[int, int]]:
        """Spans of names: disclosive words anywhere, and words that disclose a person's place where one is announced."""
        found = list(self._disclosed())
        starts = [s for s, _ in found]
        longer: list[tuple[tuple[int, int], list[int]]] = []
        for m in announced(self.folded, self.words):
            span = self._announced(m)
            if not span:
                continue
            # a longer announced name takes the place of the parts found in it
            lo = max(bisect_right(starts, span[0]) - 1, 0)
            hit = []
            while lo < len(found) and found[lo][0] < span[1]:
                if found[lo][1] > span[0]:
                    hit.append(lo)
                lo += 1
            if all(span[0] <= found[i][0] and found[i][1] <= span[1] for i in hit):
                longer.append((span, hit))
        gone = {i for _, hit in longer for i in hit}
        return sorted([x for i, x in enumerate(found) if i not in gone] + [span for span, _ in longer])

    def _told(self, first: int, last: int) -> bool:
        """Whether words (places among the slice's words) disclose a person's place as given name and surname."""
        h = self.words.hash
        given = max(self.lexicon[FIRST].one(h[first])[0], self.lexicon[GIVEN].one(h[first])[0])
        return given >= GIVEN_SHARE and max(self.lexicon[LAST].one(h[last])[0], self.single[last]) >= LAST_SHARE

    def _announced(self, m: re.Match) -> tuple[int, int] | None:
        w = self.words
        if m.re is SEED_B:
            first, last = w.at(m.start("first")), w.at(m.start("last"))
            whole = [first, last] + [last + 1] * ("-" in m["last"])
            ok = w.upper[first] and w.upper[last] and not among(w.hash[whole], _NOUNS).any()
            return (m.start("last"), m.end("first")) if ok and self._told(first, last) else None
        places = list(re.finditer(r"\S+", m["run"]))
        at = [w.at(m.start("run") + x.start()) for x in places]
        if len(at) == 3 and (not w.upper[at[2]] or self.single[at[1]] and not self.share[self.place[at[2]]]):
            at.pop()
        if not w.upper[at].all() or among(w.hash[at], _NOUNS).any() or self.given[self.place[at[-1]]] or not self._told(at[0], at[-1]):
            return None
        start = m.start("run")
        return start, start + places[len(at) - 1].end()

    def _disclosed(self) -> Iterator[tuple[int, int]]:
        n = len(self.start)
        if n < 2:
            return
        given, share, joined = self.given, self.share, self.joined
        after, twice = np.roll(share, -1), np.roll(share, -2)
        likely = joined & (after * given >= MENTION_SHARE)
        likely |= joined & np.roll(joined, -1) & (np.roll(given, -1) > 0) & (twice * given >= MENTION_SHARE)
        likely |= np.roll(self.comma, 1) & (np.roll(share, 1) * given >= MENTION_SHARE)
        free = 0  # words before this one belong to a name
        for i in np.flatnonzero(likely & (given > 0)).tolist():
            if i < free:
                continue
            for first, last in ((i - 1, self._last_first(i, free)), (i, self._first_last(i))):
                if last:
                    yield int(self.start[first]), int(self.end[last])
                    free = last + 1
                    break

    def _first_last(self, i: int) -> int:
        """Index of the surname after one or two given names from word ``i`` on, or 0."""
        n = len(self.start)
        two = self.joined[i] and i + 2 < n and self.given[i + 1] > 0 and self.joined[i + 1]
        for k in (2, 1) if two else (1,):
            if i + k < n and self.joined[i + k - 1]:
                last = i + k
                if not self.noun[last] and self.share[last] * self.given[i] >= MENTION_SHARE and not self._thing(last):
                    return last
        return 0

    def _last_first(self, i: int, free: int) -> int:
        """Index of the last given name where word ``i`` follows a surname and a comma, or 0."""
        if i - 1 < free or not self.comma[i - 1] or self.share[i - 1] * self.given[i] < MENTION_SHARE:
            return 0
        last, n = i, len(self.start)
        if self.joined[i] and i + 1 < n and self.given[i + 1] > 0 and not (self.joined[i + 1] and i + 2 < n and self.share[i + 2] > 0):
            last = i + 1
        return 0 if self._thing(last) else last

    def _thing(self, last: int) -> bool:
        """Whether the next word makes it the name of a place, body, road or building."""
        return bool(self.joined[last] and last + 1 < len(self.noun) and self.noun[last + 1])


def mentions(texts: list[str | None], spans: list[bytes | None], lexicon: Lexicon) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) in each text, in order."""
    s = Slice(texts)
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    blank: list[tuple[int, int]] = []
    for i, held in enumerate(spans):
        taken: list[tuple[int, int]] = []
        base = int(s.bounds[i])
        for row in np.frombuffer(held, _SPAN).tolist() if held else ():
            c = Candidate(*row)
            at = bisect_right(taken, (c.start, c.end))
            free = (at == 0 or taken[at - 1][1] <= c.start) and (at == len(taken) or c.end <= taken[at][0])
            if free and lexicon.number_share(c) >= NUMBER_SHARE:
                taken.insert(at, (c.start, c.end))
                out[i].append((*s.span(i, base + c.start, base + c.end), KINDS[c.kind]))
        blank += [(base + a, base + b) for a, b in taken]
    bounds = s.bounds.tolist()
    for a, b in Names(s.folded, s.words.without(blank), lexicon).find():
        i = bisect_right(bounds, a) - 1
        out[i].append((*s.span(i, a, b), "name"))
    return [sorted(x) for x in out]


def _by_block(docs: DataFrame, doc_id: str, text: str, work: Callable[[pa.Table, list[list[tuple[int, int, str]]]], pa.Table], out: str, lexicon: DataFrame | None = None) -> DataFrame:
    """``work`` on the (doc_id, text) of each block and their mentions."""
    read = materialize(_read(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))), "read")
    if lexicon is None:
        lexicon = disclosive(read)
    words = read.filter(F.col("part") == TERM).select("block", F.explode(F.array("a", *_ends_columns())).alias("t")).filter("t != 0")
    numbers = read.filter((F.col("part") == DOCUMENT) & F.col("spans").isNotNull()).select("block", "spans").mapInArrow(_asked, "block bigint, t bigint")
    asked = words.unionByName(numbers).distinct()
    tables = asked.join(lexicon, F.col("t") == F.col("term")).select(F.col("block").alias("b"), "role", "term", "share", "n")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Lexicon(*(right.column(c).to_numpy() for c in ("role", "term", "share", "n")))
        return work(left, mentions(left.column("text").to_pylist(), left.column("spans").to_pylist(), known))

    rows = read.filter(F.col("part") == DOCUMENT).select("block", "doc_id", "text", "spans")
    return rows.groupBy("block").cogroup(tables.groupBy("b")).applyInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, {out}")


def _asked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (block, spans): the contexts of the numbers of each block."""
    for batch in it:
        rows = [(b, t) for b, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in np.frombuffer(held, _SPAN) for t in (int(x["both"]), int(x["last"])) if t]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["block", "t"])


def corpus_lexicon(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What a corpus says of its words (see :func:`disclosive`), to be used on other, smaller ones."""
    return disclosive(materialize(_read(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))), "read"))


def find_personal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lexicon: DataFrame | None = None) -> DataFrame:
    """(doc_id, kind, mention), distinct. Terms are those of the documents themselves, or of a given corpus."""

    def work(rows: pa.Table, found: list[list[tuple[int, int, str]]]) -> pa.Table:
        places, kinds, held = [], [], []
        for i, (t, spans) in enumerate(zip(rows.column("text").to_pylist(), found)):
            for s, e, kind in spans:
                places.append(i)
                kinds.append(kind)
                held.append(t[s:e])
        return pa.table({"doc_id": rows.column("doc_id").take(pa.array(places, pa.int64())), "kind": pa.array(kinds, pa.string()), "mention": pa.array(held, pa.string())})

    return _by_block(docs, doc_id, text, work, "kind string, mention string", lexicon).distinct()


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lexicon: DataFrame | None = None) -> DataFrame:
    """(doc_id, text) with each mention replaced by ``[EMAIL]``, ``[PHONE]`` and so on; all else unchanged."""

    def work(rows: pa.Table, found: list[list[tuple[int, int, str]]]) -> pa.Table:
        out: list[str | None] = []
        for t, spans in zip(rows.column("text").to_pylist(), found):
            if spans:
                parts, at = [], 0
                for s, e, kind in spans:
                    parts += [t[at:s], f"[{kind.upper()}]"]
                    at = e
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.table({"doc_id": rows.column("doc_id"), "text": pa.array(out, pa.string())})

    return _by_block(docs, doc_id, text, work, "text string", lexicon)


def personal_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 8 over the whole of documents."""
    return find_personal(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


def redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
