import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import words as W


def plain(t):
    t = regex.sub(r"[\p{M}\p{Cf}]", "", unicodedata.normalize("NFKD", t or "")).lower().replace("ı", "i")
    return regex.findall(r"[\p{L}\p{N}]+", t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=6))
def test_batch_is_text_by_text(texts):
    words, offsets = W.word_lists(texts)
    assert len(offsets) == max(len(texts), 1) + 1 or not texts
    for i, t in enumerate(texts):
        assert words[offsets[i] : offsets[i + 1]] == plain(t)


def test_known_words():
    words, _ = W.word_lists(["İstanbul'da IŞIK ıslak, ﬁne x² \0 Ğ​ö"])
    assert words == ["istanbul", "da", "isik", "islak", "fine", "x2", "go"]


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=8), min_size=1, max_size=5))
def test_triples_and_similarity(docs):
    texts = [" ".join(d) for d in docs]
    words, offsets = W.word_lists(texts)
    values, at = W.distinct(*W.triples(W.hash_words(words), offsets))
    sets = [{tuple(d[i : i + 3]) for i in range(len(d) - 2)} for d in docs]
    assert np.diff(at).tolist() == [len(s) for s in sets]
    one = (np.tile(values[: at[1]], len(docs)), np.arange(len(docs) + 1) * at[1])
    for got, s in zip(W.hamming(one, (values, at)), sets):
        a, b = sets[0], s
        assert got == len(a ^ b)


def test_binary_cells():
    values, offsets = np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3])
    cells = W.binary_list(values, offsets)
    for c in (cells, pa.chunked_array([cells])):
        v, o = W.from_binary(c, np.uint32)
        assert v.tolist() == [5, 6, 7] and o.tolist() == [0, 2, 2, 3]
    v, o = W.from_binary(cells.slice(1), np.uint32)
    assert v.tolist() == [7] and o.tolist() == [0, 0, 1]


def test_slices_cover(monkeypatch):
    monkeypatch.setattr(W, "SLICE_CHARS", 10)
    texts = ["x" * n for n in (4, 4, 4, 50, 0, 1)] + [None]
    cut = list(W.slices(texts))
    assert cut[0][0] == 0 and cut[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(cut, cut[1:])) and (3, 4) not in [(0, 1)]
    assert list(W.slices([])) == []
