import collections
import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import encoding, folding, forms, leakage, mixing, pii, tokens

VOCAB = tokens.tokenizer_path("byte_bpe_50k.tiktoken")
ODD = ["", None, " ", "\n\n\n", "a", "<|endoftext|> x", "ğüşıöç İĞÜŞÖÇ", "I'll it's we'VE o'nun", "x" * 5000, "12 345\t6", "a\x1cb\x85c\xa0d e　f", "é ​😀👨‍👩‍👧", "tab\t\tend  ", "a  b   c\n \n d", "\0 null", "!!??..."]


@pytest.fixture(scope="module")
def bpe():
    pytest.importorskip("tiktoken")
    try:
        return tokens.load_bpe(VOCAB)
    except FileNotFoundError:
        pytest.skip("no vocabulary files")


def odd_docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(0, "", "x", 1), (None, "no id", "x", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, word string, block int")


def test_encoding(spark, bpe, monkeypatch):
    monkeypatch.setattr(encoding, "BLOCK_ROWS", 3)
    monkeypatch.setattr(encoding, "BLOCK_WORDS", 50)
    got = encoding.encode_corpus(odd_docs(spark)).collect()
    assert len(got) == len(ODD) + 2
    by_id = {r.doc_id: r.ids for r in got}
    assert by_id == {**{i: bpe.encode_ordinary(t or "") for i, t in enumerate(ODD)}, None: bpe.encode_ordinary("no id")}
    back = encoding.decode_corpus(encoding.encode_corpus(odd_docs(spark)), encoding.pieces(spark)).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter([*((i, t or "") for i, t in enumerate(ODD)), (0, ""), (None, "no id")])
    assert encoding.encode_corpus(odd_docs(spark).limit(0)).count() == 0


def test_token_counts(spark, bpe):
    got = tokens.count_tokens(odd_docs(spark), "text", ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got if r.doc_id) == [(i, len(bpe.encode_ordinary(t or ""))) for i, t in enumerate(ODD) if i]


def test_labels_as_read(spark):
    rows = [("s", 0, '{"type": " News", "lang": "TR"}'), ("s", 0, '{"type": "x"'), ("s", 1, '{"type": null, "lang": "tr-TR"}'), ("s", 2, "{bad"), ("s", 3, '{"type": "b"}'), ("s", 3, '{"type": "a"}'), ("s", 4, None)]
    df = spark.createDataFrame(rows, "source_id string, row_ordinal bigint, predicted_label_json string")
    got = {r.row_ordinal: (r.lang, r.type) for r in tokens.label_fields(df).collect()}
    assert got == {0: ("tr", "news"), 1: ("tr", None), 2: (None, None), 3: (None, "a"), 4: (None, None)}


def test_slices_add_up(spark, tiny, bpe):
    one = tokens.token_counts(spark, tiny)
    n, b, t = one.agg(F.count(F.lit(1)), F.sum("n_bytes"), F.sum("n_tokens")).first()
    upstream = spark.read.parquet(f"{tiny}/upstream_identity_v1.parquet")
    assert n == upstream.count() and b == upstream.agg(F.sum(F.octet_length("text"))).first()[0]
    for level, total in collections.Counter({r.level: 0 for r in []}).items():
        assert total
    for r in tokens.token_slices(spark, tiny).groupBy("level").agg(F.sum("n_texts").alias("n"), F.sum("n_tokens").alias("t")).collect():
        assert (r.n, r.t) == (n, t)


def records(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = [(s, k, rng.randint(50, 150), rng.choice([0.1, 1.0])) for s, n in sizes.items() for k in range(n)] + [(None, 1, 9, 1.0), ("a", 10**6, 0, 1.0), ("a", 10**6 + 1, None, 1.0)]
    return spark.createDataFrame(rows, "id string, ordinal bigint, n_bytes bigint, weight double").withColumn("bucket", F.lit("own"))


@pytest.mark.parametrize("most", [20_000, 30])
def test_mixture_reaches_its_shares(spark, monkeypatch, most):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", most)
    monkeypatch.setattr(mixing, "BUCKETS", 4)
    sizes = {"a": 3000, "b": 400, "tiny": 40, "zero": 50, "null": 50}
    quotas = {"a": 60, "b": 30, "tiny": 10, "zero": 0, "null": None, "none": 5}
    df = records(spark, sizes)
    chosen, shares = mixing.mix(df, quotas)
    rows = chosen.collect()
    assert len({(r.id, r.ordinal) for r in rows}) == len(rows) and max(r.repeats for r in rows) <= 4
    assert {r.id for r in rows} == {"a", "b", "tiny"}
    total = sum(r.n_bytes * r.repeats for r in rows)
    got = {s.id: s for s in shares.collect()}
    for s, q in (("a", 60), ("b", 30), ("tiny", 10)):
        assert abs(sum(r.n_bytes * r.repeats for r in rows if r.id == s) - total * q / 100) <= 160
        assert abs(got[s].actual_share - got[s].reachable_share) < 0.01 and got[s].target_share < got[s].reachable_share
        uses = {r.repeats for r in rows if r.id == s}
        assert max(uses) - min(uses) <= 1 and (min(uses) == 1 or len([r for r in rows if r.id == s]) == sizes[s])
    assert got["none"].actual_bytes == got["zero"].actual_bytes == 0 and got["none"].target_share > 0
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(df.repartition(5), quotas)[0].collect()))


def test_small_sources_fall_short_of_a_large_total(spark):
    chosen, shares = mixing.mix(records(spark, {"a": 2000, "tiny": 10}), {"a": 50, "tiny": 50}, total=150_000)
    got = {s.id: s for s in shares.collect()}
    assert got["tiny"].largest_repeat == 4 and got["tiny"].actual_bytes == 4 * got["tiny"].available_bytes
    assert abs(got["a"].actual_bytes - 75_000) <= 160 and got["tiny"].actual_share < 0.1


def test_weights_draw(spark):
    rows = [("a", k, 100, 1.0 if k % 2 else 0.1) for k in range(4000)]
    chosen, _ = mixing.mix(spark.createDataFrame(rows, "id string, ordinal bigint, n_bytes bigint, weight double"), {"a": 1}, total=100_000)
    odd = sum(r.ordinal % 2 for r in chosen.collect())
    assert 850 < odd < 980 and chosen.count() == 1000


def test_nothing_to_mix(spark):
    none = spark.createDataFrame([], "id string, ordinal bigint, n_bytes bigint, weight double")
    chosen, shares = mixing.mix(none, {"a": 1})
    assert chosen.count() == 0 and [s.actual_share for s in shares.collect()] == [0.0]


def test_tiles():
    prompt = [f"w{i}" for i in range(40)]
    text = ["x", *prompt[20:35], "y", *prompt[:15], "z", *prompt[30:39]]
    index = collections.defaultdict(list)
    for p in range(31):
        index[tuple(prompt[p : p + 10])].append(p)
    seeds = np.array([(t, p) for t in range(len(text) - 9) for p in index.get(tuple(text[t : t + 10]), ())])
    tiles = leakage.greedy_tiles(text, prompt, seeds[:, 0], seeds[:, 1], 10)
    assert sorted(tiles) == [(1, 20, 15), (17, 0, 15)]


@given(st.lists(st.sampled_from("ab"), min_size=1, max_size=30), st.lists(st.sampled_from("ab"), min_size=1, max_size=14))
def test_tiles_are_those_of_step_by_step_tiling(text, prompt):
    least = 3
    seeds = np.array([(t, p) for t in range(len(text) - 2) for p in range(len(prompt) - 2) if text[t : t + 3] == prompt[p : p + 3]], np.int64).reshape(-1, 2)
    got = leakage.greedy_tiles(text, prompt, seeds[:, 0], seeds[:, 1], least)
    used_text, used_prompt, want = set(), set(), []
    while True:
        best = (least - 1, 0, 0)
        for t in range(len(text)):
            for p in range(len(prompt)):
                n = 0
                while t + n < len(text) and p + n < len(prompt) and text[t + n] == prompt[p + n] and t + n not in used_text and p + n not in used_prompt:
                    n += 1
                best = max(best, (n, -t, -p))
        if best[0] < least:
            break
        n, t, p = best[0], -best[1], -best[2]
        want.append((t, p, n))
        used_text |= set(range(t, t + n))
        used_prompt |= set(range(p, p + n))
    assert got == want


def test_rolling():
    h = np.arange(1, 30, dtype=np.uint32)
    runs = leakage.rolling(h, 10)
    assert len(runs) == 20 and len(set(runs.tolist())) == 20
    assert leakage.rolling(np.tile(h[:10], 2), 10)[0] == leakage.rolling(np.tile(h[:10], 2), 10)[10]
    assert len(leakage.rolling(h[:9], 10)) == 0


@pytest.mark.parametrize("table", [2_000_000, 100])
def test_leaks(spark, monkeypatch, table):
    monkeypatch.setattr(leakage, "ITEM_BYTES", table)
    rng = random.Random(1)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    prompts = [[word() for _ in range(rng.choice([3, 9, 10, 30]))] for _ in range(12)]
    items = [(f"i{k}", " ".join(p)) for k, p in enumerate(prompts)] + [("twin", " ".join(prompts[3]).upper()), ("null", None), (None, "a"), ("i0", " ".join(prompts[0]))]
    docs = []
    for k in range(60):
        p = rng.choice(prompts)
        a = rng.randint(0, len(p))
        docs.append((k, " ".join([word() for _ in range(8)] + p[a : a + rng.choice([5, 9, 10, 12, 30])] + [word() for _ in range(8)]), "x"))
    docs += [docs[0], (100, None, "x"), (101, "", "x"), (None, items[3][1], "x")]
    names = collections.defaultdict(set)
    for i, p in items:
        if p and i:
            names[tuple(p.lower().split())].add(i)
    want = set()
    for d, t, _ in docs:
        w = (t or "").split()
        runs = {tuple(w[k : k + 10]) for k in range(len(w) - 9)}
        want |= {(i, d) for p, ids in names.items() for i in ids if runs & {p[k : k + 10] for k in range(len(p) - 9)}}
    got = leakage.tiles_of(spark.createDataFrame(docs, "doc_id bigint, text string, item_id string"), spark.createDataFrame(items, "id string, prompt string")).collect()
    assert len(got) == len(want) and {(r.item_id, r.doc_id) for r in got} == want
    assert all(10 <= r.longest <= r.words and 0 < r.coverage <= 1 for r in got)
    most = leakage.tiles_of(spark.createDataFrame(docs, "doc_id bigint, text string, item_id string"), spark.createDataFrame(items, "id string, prompt string"), least_coverage=0.9).collect()
    assert sorted(map(str, most)) == sorted(str(r) for r in got if r.coverage >= 0.9)


def test_no_prompts(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([], "id string, prompt string")
    assert leakage.tiles_of(docs, items).count() == 0


FORMS = [
    ("Yaz: ali.veli+x@posta.example.com, tamam", [("email", "ali.veli+x@posta.example.com")]),
    ("mailto:a_b @ c.example", [("email", "a_b @ c.example")]),
    ("<INFO1@EXAMPLE.ORG>", [("email", "INFO1@EXAMPLE.ORG")]),
    ("(bilgi8 (at) kurum (nokta) example)", [("email", "bilgi8 (at) kurum (nokta) example")]),
    ("ada_3 et posta nokta example oldu", [("email", "ada_3 et posta nokta example")]),
    ("x＠y.test.", [("email", "x＠y.test")]),
    ("foto kale@2x.png ve @hesap, at et bir", []),
    ("Tel. 0599 926 22 27 (dahili 12)", [("phone", "0599 926 22 27")]),
    ("(0 (299) 208 90 88)", [("phone", "0 (299) 208 90 88")]),
    ("((202) 555 0124)", [("phone", "(202) 555 0124")]),
    ("+90 571 901-61-24; 0090 571 901 61 24", [("phone", "+90 571 901-61-24"), ("phone", "0090 571 901 61 24")]),
    ("Gsm 0\xa0571\xa0776\xa01355", [("phone", "0\xa0571\xa0776\xa01355")]),
    ("+44 7700 900 914, 020 7946 0351", [("phone", "+44 7700 900 914"), ("phone", "020 7946 0351")]),
    ("ISBN 978-605-0222-17-9, IBAN: TR00 0000 9487 4313 2562, dizi 12 812 46 77", []),
    ("TCKN 10000000146.", [("id_number", "10000000146")]),
    ("(100 000 001 46) 10000 000146", [("id_number", "100 000 001 46"), ("id_number", "10000 000146")]),
    ("Takip kodu 10000000146, Fatura no: 10000000146", []),
    ("TCKN 10000000147", []),
    ("NI no: QQ 12 34 56 C", [("id_number", "QQ 12 34 56 C")]),
    ("Adres: Dutluk Mah. 1023. Sok. No: 91/17 Obaağaç.", [("address", "Dutluk Mah. 1023. Sok. No: 91/17 Obaağaç")]),
    ("Ev Dutluk Mahallesi, Çınar Sokak No:58 Daire:2, 99236 Bozdere adresinde", [("address", "Dutluk Mahallesi, Çınar Sokak No:58 Daire:2, 99236 Bozdere")]),
    ("yeri Zambak Cad. 83/3 oldu", [("address", "Zambak Cad. 83/3")]),
    ("at Flat 9, 143 Tanner Avenue. Why", [("address", "Flat 9, 143 Tanner Avenue")]),
    ("Çınar Sokak boyunca, Dutluk Mahallesi sakinleri 44. kez; Market Street was busy; 3 mahallesi olan", []),
]


NOTHING = pii.Lexicon(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))


def found(texts, lexicon=NOTHING):
    s = folding.Slice(texts)
    spans = [[] for _ in texts]
    for c in forms.candidates(s)[0]:
        i = int(np.searchsorted(s.bounds, c.start, "right")) - 1
        spans[i].append((c.start - s.bounds[i], c.end - s.bounds[i], *c[2:]))
    return pii.mentions(texts, [np.array(x, pii._SPAN).tobytes() if x else None for x in spans], lexicon)


@pytest.mark.parametrize("text,want", FORMS)
def test_forms(text, want):
    assert [(k, text[s:e]) for s, e, k in found([text])[0] if k != "name"] == want


def test_forms_in_one_slice():
    texts = [t for t, _ in FORMS] + ["", None, "\0"]
    for (text, want), got in zip(FORMS, found(texts)):
        assert [(k, text[s:e]) for s, e, k in got if k != "name"] == want


def test_folding_keeps_places():
    texts = ["Şule Ağ", "Şule", None, "ülke ＠", "TÃ¼rk SayÄ±n", "a​b ½ ﬁ 😀", "", "x" * 10, "\0a"]
    f = folding.Slice(texts)
    assert len(f.bounds) == len(texts) + 1
    for i, text in enumerate(texts):
        for at in range(int(f.bounds[i]), int(f.bounds[i + 1]) - 1):
            s, e = f.span(i, at, at + 1)
            assert 0 <= s < e <= len(text)
    text = "SayÄ±n Ş​ule"
    f = folding.Slice(["", text])
    assert f.folded == "\0Sayin Sule" and text[slice(*f.span(1, 7, 11))] == "Ş​ule"


@given(st.lists(st.text(alphabet="aBçÇıİ\u0301 -.1\n", max_size=30), min_size=1, max_size=6))
def test_words_of_a_slice(texts):
    s = folding.Slice(texts)
    want = [(m[0].lower(), i) for i, t in enumerate(s.folded.split("\0")) for m in re.finditer("[A-Za-z]{2,}", t)]
    got = s.words
    assert [folding.word_hash(w) for w, _ in want] == got.hash.tolist()
    ends = got.endings(np.arange(len(got)))
    for j, k in enumerate(folding.ENDINGS):
        assert [folding.word_hash(w[-k:]) if len(w) >= k + 2 else 0 for w, _ in want] == ends[j].tolist()


def test_words_before_a_number_disclose_it(spark):
    good, bad = "10000000146", "10000000147"
    docs = [f"Zarf no {bad} geldi." for _ in range(20)] + [f"Zarf no {good} geldi.", f"Sicili {good} oldu."]
    docs += [f"Rehber +90 571 901 {k} 24." for k in range(10, 30)] + ["Rehber 5719016124.", "Koli 5719016124."]
    rows = pii.find_personal(spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")).collect()
    got = {(r.doc_id, r.kind, r.mention) for r in rows}
    assert {r for r in got if r[1] == "id_number"} == {(21, "id_number", good)}
    assert (42, "phone", "5719016124") in got and not any(d == 43 for d, _, _ in got)


def people(n=400, seed=1):
    rng = random.Random(seed)
    firsts = ["Tolga", "Selin", "Övgü", "Şule", "Nehir", "Barış", "İpek", "Onur"]
    last = [a + b for a in ("Yaz", "Boz", "Kara", "Taş", "Göksu") for b in ("tepeli", "dereli", "çamoğlu")]
    docs, want = [], set()
    for k in range(n):
        name = f"{rng.choice(firsts)} {rng.choice(last)}"
        shown = rng.choice([name, name.upper().replace("I", "I"), name])
        text = rng.choice(["Sayın {}, dilekçeniz alındı.", "Yazan: {};", "Dr. {} bulguları sundu.", "Kitabı {} çevirdi.", "Komşumuz {} dün taşındı.", "{}'ın dükkânı kapandı."]).format(shown)
        docs.append((k, f"{text} Nehir boyunca yağmur ve barış sürdü. {rng.choice(['Barış Parkı açıldı.', 'Onur Caddesi kapandı.', 'Sayın Kurul Üyeleri, gündem ektedir.', 'Yazan: Akköy Haber Merkezi'])}"))
        want.add((k, "name", shown))
    return docs, want


def test_names(spark):
    docs, want = people()
    df = spark.createDataFrame([*docs, docs[0], (None, None), (900, "")], "doc_id bigint, text string").withColumn("kind", F.lit(1))
    got = {tuple(r) for r in pii.find_personal(df).collect()}
    assert len(got & want) > 0.97 * len(want) and len(got - want) <= 0.02 * len(want)


def test_rare_names_stay_in_large_lexicons(spark, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK_CHARS", 5000)
    docs, _ = people()
    last = ["Boztepeli", "Karadereli", "Yazçamoğlu"]
    docs += [(1000 + k, f"Sayın Nazende {x}, dilekçeniz alındı.") for k, x in enumerate(last)]
    docs += [(1100, "Kitabı Nazende Taştepeli çevirdi.")]
    got = {tuple(r) for r in pii.find_personal(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert (1100, "name", "Nazende Taştepeli") in got


def test_lexicon_of_another_corpus(spark):
    docs, _ = people()
    one = spark.createDataFrame([(1, "Dün Selin Boztepeli geldi.")], "doc_id bigint, text string")
    assert pii.find_personal(one).count() == 0
    lexicon = pii.corpus_lexicon(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert [tuple(r) for r in pii.find_personal(one, lexicon=lexicon).collect()] == [(1, "name", "Selin Boztepeli")]


def test_redaction(spark):
    docs, _ = people(200)
    text = "Sayın Selin Boztepeli, a@b.example; Tel. 0599 926 22 27 ğ\n"
    df = spark.createDataFrame([*docs, (1000, text), (1001, None), (1002, ""), (1003, "düz yazı")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got[1000] == "Sayın [NAME], [EMAIL]; Tel. [PHONE] ğ\n"
    assert (got[1001], got[1002], got[1003]) == (None, "", "düz yazı")
    assert pii.find_personal(df.limit(0)).count() == 0
