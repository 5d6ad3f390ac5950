import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import mixing as M


def race(streams, weights):
    at, given, out = [0] * len(streams), [0] * len(streams), []
    while True:
        i = min(range(len(streams)), key=lambda j: given[j] / weights[j])
        if at[i] == len(streams[i]):
            return out
        out.append((i, at[i]))
        given[i] += streams[i][at[i]] + 1
        at[i] += 1


def test_token_deficit_mix(spark):
    rng = random.Random(3)
    for _ in range(4):
        weights = [rng.choice([0.8, 0.2, 0.1, 1.0]) for _ in range(3)]
        streams = [[rng.choice([0, 1, 9, 99]) for _ in range(rng.randint(1, 60))] for _ in range(3)]
        rows = [(i, k, n) for i, s in enumerate(streams) for k, n in enumerate(s)]
        df = spark.createDataFrame(rows, "s bigint, k bigint, n bigint")
        got = M.token_deficit_mix(df, "s", F.col("n"), ["k"], dict(enumerate(weights))).orderBy("pos").collect()
        assert [(r.s, r.k) for r in got] == race(streams, weights)
    assert M.token_deficit_mix(df, "s", F.col("n"), ["k"], {0: 1.0, 7: 1.0}).count() <= 1
    with pytest.raises(ValueError):
        M.token_deficit_mix(df, "s", F.col("n"), ["k"], {0: 0.0})


def drawn(first, second, ratio, seed, most):
    rng, out, k, done = random.Random(seed), [], [0, 0], [False, False]
    while not all(done) and not (most is not None and len(out) >= most):
        side = 0 if rng.random() < ratio else 1
        side = 1 if done[0] else 0 if done[1] else side
        if k[side] < (first, second)[side]:
            out.append((side, k[side]))
            k[side] += 1
        else:
            done[side] = True
    return out


@pytest.mark.parametrize("first,second,most", [(300, 100, 200), (300, 100, None), (5, 400, None), (0, 30, None), (30, 0, None), (0, 0, None), (400, 3, 401), (700, 700, None)])
def test_bernoulli_schedule(spark, monkeypatch, first, second, most):
    monkeypatch.setattr(M, "DRAWS", 128)
    for seed in (7, 42):
        got = M.bernoulli_schedule(spark, first, second, 0.75, seed, most).orderBy("pos").collect()
        assert [(r.side, r.k) for r in got] == drawn(first, second, 0.75, seed, most)
        assert [r.pos for r in got] == list(range(len(got)))


def test_bernoulli_mix(spark):
    a = spark.createDataFrame([(i, f"a{i}") for i in range(30)], "d bigint, t string")
    b = spark.createDataFrame([(i, f"b{i}") for i in range(10)], "d bigint, t string")
    got = [r.t for r in M.bernoulli_mix(a, b, ["d"], 0.75, 7).orderBy("pos").collect()]
    assert got == [f"{'ab'[s]}{k}" for s, k in drawn(30, 10, 0.75, 7, None)]
    assert M.observed_ratio(a, F.lit(True)).first().ratio == 1.0 and M.observed_ratio(a.limit(0), F.lit(True)).first().ratio == 0.0


def test_rows_without_language_are_in_the_second_stream(spark, tmp_path):
    from millrace.plans import registry

    rows = [(i, "bir", lang) for i, lang in enumerate(["tr"] * 20 + ["en"] * 3 + [None] * 3)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [r.doc_id for r in registry.QUERIES["bernoulli_mix"](spark, str(tmp_path)).collect() if r.side == 1]
    assert sorted(got) == list(range(20, 26))
