import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import metrics
from millrace.operators import packing as P


def pack(spark, docs, length, budget=None):
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(docs)], "k bigint, source string, ids array<int>")
    return P.pack(df, F.col("ids"), "source", ["k"], length, budget=budget).orderBy("chunk_id").collect()


def test_two_sources_and_padding(spark):
    got = pack(spark, [("x", [70_000, 8]), ("y", [9]), ("x", [10])], 5)
    assert [t for r in got for t in r.tokens] == [70_000, 8, 2, 9, 2, 10, 2, 2, 2, 2]
    assert [s for r in got for s in r.token_sources] == ["x", "x", "x", "y", "y", "x", "x", None, None, None]
    assert [r.valid_length for r in got] == [5, 2] and got[0].source == "x"


def test_budget_cuts_inside_a_document(spark):
    got = pack(spark, [(None, [11, 12]), (None, [13, 14, 15, 16]), (None, [17])], 3, budget=4)
    assert [t for r in got for t in r.tokens] == [11, 12, 2, 13, 2, 2] and [r.valid_length for r in got] == [3, 1]
    assert {r.source for r in got} == {"unknown"}


@pytest.mark.parametrize("seed", range(4))
def test_against_a_stream(spark, seed):
    rng = random.Random(seed)
    docs = [(rng.choice("abc"), [rng.randint(3, 99) for _ in range(rng.choice([0, 1, 2, 5, 30]))]) for _ in range(60)]
    budget = rng.choice([None, 1, 100, 333])
    stream = [(t, s) for s, ids in docs if ids for t in [*ids, 2]][:budget]
    got = pack(spark, docs, 8, budget)
    assert [(t, s) for r in got for t, s in list(zip(r.tokens, r.token_sources))[: r.valid_length]] == stream
    for r, at in zip(got, range(0, len(stream), 8)):
        part = [s for _, s in stream[at : at + 8]]
        assert r.source == max(part, key=lambda s: (part.count(s), -part.index(s))) and len(r.tokens) == 8
    df = spark.createDataFrame([(i, s, len(t)) for i, (s, t) in enumerate(docs)], "k bigint, source string, n bigint")
    placed = P.placed(df, F.col("n"), ["k"], budget)
    counts = {r.source: (r.n_tokens, r.n_chunks) for r in P.source_tokens(P.slices(placed, 8), "source").collect()}
    assert {s: n for s, (n, _) in counts.items()} == {s: sum(x == s for _, x in stream) for s in {x for _, x in stream}}
    assert sum(c for _, c in counts.values()) == len(got)
    before, n = 0, 0
    for _, ids in docs:
        n += budget is None or before < budget
        before += len(ids) + 1 if ids else 0
    assert placed.count() == n


def test_code_points_and_vocabulary(spark):
    df = spark.createDataFrame([(0, "aş😀"), (1, ""), (2, None)], "k bigint, t string")
    assert [r[0] for r in df.select(P.code_points(F.col("t"))).collect()] == [[97, 351, 128512], [], []]
    with pytest.raises(Exception, match="outside the vocabulary"):
        P.pack(df, P.code_points(F.col("t")), "t", ["k"], 4, vocabulary=256).collect()


def test_examples_files_and_limits(spark):
    df = spark.createDataFrame([(0, "f", 5), (1, "f", 0), (2, "g", 3), (3, "h", 4)], "k bigint, f string, n bigint")
    chunks = {r.f: (r.chunks, r.kept_tail) for r in P.per_file_chunks(df, F.col("n"), "f", ["k"], 4).collect()}
    assert chunks == {"f": (2, True), "g": (1, False), "h": (1, False)}
    packed = P.pack(df.withColumn("ids", F.array_repeat(F.lit(7), F.col("n").cast("int"))), F.col("ids"), "f", ["k"], 8)
    rows = P.training_examples(packed).orderBy("chunk_id").collect()
    assert sum(sum(r.attention_mask) for r in rows) == 15
    assert all((x == -100) == (m == 0) for r in rows for x, m in zip(r.labels, r.attention_mask))
    assert P.first_chunks(packed, 0).count() == 0 and P.first_chunks(packed, 1).count() == 1
    with pytest.raises(ValueError):
        P.first_chunks(packed, -1)
    assert [r[0] for r in spark.range(5).select(P.shard_of(F.col("id"), 2)).collect()] == [0, 0, 1, 1, 2]


def test_training_counters(spark):
    df = spark.createDataFrame([(i, 2) for i in range(5)], "chunk_id bigint, valid_length bigint")
    assert tuple(metrics.training_counters(df).first()) == (10, 5, 5)
    assert tuple(metrics.training_counters(df, 5).first()) == (5, 2, 3)
    assert tuple(metrics.training_counters(df.limit(0)).first()) == (0, 0, 0)
