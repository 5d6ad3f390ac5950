"""Every operator on empty tables, nulls in any column, repeated rows, ties, very long texts and extra columns with clashing names."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import crosssplit, encoding, leakage, mixing, neardup, packing, pii, tokens

#: Names that the operators use inside.
CLASHING = ["block", "code", "word", "words", "key", "id", "n", "size", "term", "share", "role", "part", "spans", "place", "bucket", "query", "hash2", "_rank", "a", "b", "kind"]
_RNG = random.Random(3)
LONG = " ".join(_RNG.choice(["ada", "Bora Yaz", "çay", "0599 926 22 27", "x@y.example", "no 5", "42"]) for _ in range(120_000))


def clashing(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING) if c not in df.columns])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("1", "Sayın Bora Yaz, merhaba"), ("1", "Sayın Bora Yaz, merhaba"), (None, "bir iki üç dört"), ("2", None), (None, None), ("3", ""), ("4", LONG), ("5", "\0"), ("6", "a" * 300_000)]
    return clashing(spark.createDataFrame(rows, "doc_id string, text string"))


def test_packing(spark, docs):
    got = packing.pack(docs, "text", ["doc_id"]).groupBy("sequence").agg(F.sum("length").alias("n"), F.max("fill").alias("f")).collect()
    assert all(r.n == r.f <= 2048 for r in got) and sum(r.n for r in got) == sum(len(r.text or "") for r in docs.collect())
    assert packing.pack(docs.limit(0), "text", ["doc_id"]).count() == 0


def test_encoding_and_counts(spark, docs):
    if not os.path.exists(tokens.tokenizer_path("byte_bpe_50k.tiktoken")):
        pytest.skip("no vocabulary files")
    got = encoding.encode_corpus(docs).collect()
    encode = tokens.load_bpe(tokens.tokenizer_path("byte_bpe_50k.tiktoken")).encode_ordinary
    key = lambda i, ids: (str(i), len(ids), hashlib.md5(str(list(ids)).encode()).hexdigest())
    assert sorted(key(r.doc_id, r.ids) for r in got) == sorted(key(r.doc_id, encode(r.text or "")) for r in docs.collect())
    assert encoding.encode_corpus(docs.limit(0)).count() == 0
    assert encoding.decode_corpus(encoding.encode_corpus(docs), encoding.pieces(spark)).exceptAll(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).count() == 0
    counted = {(r.doc_id, r.n_tokens) for r in tokens.count_tokens(docs, "text", ["doc_id"]).collect()}
    assert counted == {(r.doc_id, len(r.ids)) for r in got}


def test_personal(spark, docs):
    got = pii.find_personal(docs).collect()
    assert len(got) == len(set(got)) and {r.doc_id for r in got} <= {"1", "4"} and {r.kind for r in got if r.doc_id == "4"} >= {"email", "phone"}
    redacted = pii.redact(docs)
    assert redacted.count() == docs.count() and redacted.filter("text IS NULL").count() == 2
    assert pii.find_personal(docs.limit(0)).count() == 0 and pii.redact(docs.filter("text IS NULL")).count() == 2


def test_leaks(spark, docs):
    items = clashing(spark.createDataFrame([("i", " ".join(LONG.split()[50:80])), ("i", " ".join(LONG.split()[50:80])), ("j", None), (None, "x"), ("k", "")], "id string, prompt string"))
    got = leakage.tiles_of(docs, items).collect()
    assert [(r.item_id, r.doc_id) for r in got] == [("i", "4")]
    assert leakage.tiles_of(docs.limit(0), items).count() == 0


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_pairs(spark):
    near = LONG.replace("çay", "su", 3)
    texts = [LONG, near, None, "", "a b", "a b c d", "a b c d", "A b, c d!"]
    upstream = clashing(spark.createDataFrame([(t,) for t in texts], "text string")).withColumn("hash", F.lit("own"))
    hashes = [sha(LONG), sha(near), sha(LONG), None, "zz", sha("a b c d"), sha("A b, c d!"), ""]
    seen = clashing(spark.createDataFrame([(h,) for h in hashes], "hash string"))
    found = neardup.NearDuplicates(seen, upstream)
    want = sorted([tuple(sorted((sha(LONG), sha(near)))), tuple(sorted((sha("a b c d"), sha("A b, c d!"))))])
    assert sorted(map(tuple, found.found().collect())) == want
    assert found.groups().count() == 6
    rows = [("train", "s", 1, sha(LONG)), ("Test", None, None, sha(near)), ("test", None, None, sha(near)), (None, "s", 1, sha(near)), ("test", "s", 2, None), ("heldout", "s", 3, sha("a b")), ("train", "s", 4, sha("a b c d")), ("test", "s", 5, sha("A b, c d!"))]
    decisions = clashing(spark.createDataFrame(rows, "split string, source_id string, ordinal bigint, content_hash string")).withColumn("hash", F.lit("own"))
    split = crosssplit.CrossSplit(decisions, upstream)
    assert sorted(map(str, split.found().collect())) == sorted(["Row(split='test', source_id=None, ordinal=None)", "Row(split='test', source_id='s', ordinal=5)"])
    assert {r.hash: (r.n_words, r.covered) for r in split.coverage().collect()}[sha("A b, c d!")] == (4, 4)
    assert crosssplit.CrossSplit(decisions.limit(0), upstream.limit(0)).report().count() == 0
    assert neardup.NearDuplicates(seen, upstream.limit(0)).found().count() == 0


def test_mixing(spark):
    rows = [("a", k, 10, 0.5) for k in range(40)] + [("b", k, None if k % 2 else 10, 1.0) for k in range(40)] + [(None, 1, 5, 1.0), ("c", 1, 0, 1.0)]
    records = clashing(spark.createDataFrame(rows, "id string, ordinal bigint, n_bytes bigint, weight double"))
    chosen, shares = mixing.mix(records, {"a": 1, "b": 1, "c": 1, "d": None})
    assert {r.id for r in chosen.collect()} == {"a", "b"}
    assert {s.id: s.actual_bytes for s in shares.collect()} == {"a": 800, "b": 800, "c": 0, "d": 0}
