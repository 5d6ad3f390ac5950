import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import order as O


def test_prefix_sums_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(O, "ROWS_PER_RANGE", 50)
    rng = random.Random(1)
    rows = [(k, rng.choice("abc") if k % 7 else None, rng.choice([None, 0, 5, 9])) for k in rng.sample(range(10_000), 900)]
    df = spark.createDataFrame(rows, "k bigint, g string, v bigint").withColumn("out", F.lit("an own column"))
    whole, within = 0, {}
    want = {}
    for k, g, v in sorted(rows):
        want[k] = (whole, within.get(g, 0))
        whole += v or 0
        within[g] = within.get(g, 0) + (v or 0)
    got = O.prefix_sum(O.prefix_sum(df, F.col("v"), ["k"], "all"), F.col("v"), ["k"], "part", by=["g"])
    assert {r.k: (r["all"], r.part) for r in got.collect()} == want


def test_many_ranges(spark, monkeypatch):
    """More ranges than the first pass finds, and more than a tree of comparisons holds."""
    monkeypatch.setattr(O, "ROWS_PER_RANGE", 2)
    monkeypatch.setattr(O, "FIRST_RANGES", 8)
    df = spark.range(3000).withColumn("v", F.col("id") % 7)
    got = O.prefix_sum(df, F.col("v"), ["id"], "before").orderBy("id").collect()
    want = 0
    for r in got:
        assert r.before == want
        want += r.v


def test_prefix_sum_of_nothing(spark):
    assert O.prefix_sum(spark.createDataFrame([], "k bigint, v bigint"), F.col("v"), ["k"], "x").collect() == []


def test_byte_budget(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([5, 0, 5, 7, 1])], "k bigint, n bigint")
    for budget, n in [(0, 0), (4, 0), (5, 2), (10, 3), (16, 3), (17, 4), (99, 5)]:
        assert O.byte_budget(df, F.col("n"), ["k"], budget).count() == n


def simulate(weights, sizes):
    score, used, on, out = [0.0] * len(sizes), [0] * len(sizes), [True] * len(sizes), []
    while any(on):
        for i in range(len(sizes)):
            if on[i]:
                score[i] += weights[i]
        best = max((i for i in range(len(sizes)) if on[i]), key=lambda i: (score[i], -i))
        score[best] -= sum(w for w, o in zip(weights, on) if o)
        if used[best] == sizes[best]:
            on[best] = False
        else:
            out.append((best, used[best]))
            used[best] += 1
    return out


def unroll(schedule):
    runs, blocks = schedule
    out = {}
    for state, n in blocks:
        turns = O._Turns.of(state)
        for _ in range(n):
            i = turns.tick()
            out[turns.pos - 1] = (i, turns.used[i] - 1)
    for i, k, step, n, pos, every in runs:
        for j in range(n):
            assert pos + j * every not in out
            out[pos + j * every] = (i, k + j * step)
    return [out[p] for p in range(len(out))]


def test_weighted_schedule(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(O, "BLOCK_TICKS", 7)
    for k in range(300):
        monkeypatch.setattr(O, "MOST_CYCLE", 20_000 if k % 2 else 6)
        n = rng.randint(1, 5)
        weights = [rng.choice([0.5, 1.0, 2.0, 3.0] if k % 3 else [0.1, 0.3, 0.7, 0.35]) for _ in range(n)]
        sizes = [rng.choice([0, 1, 3, 40]) for _ in range(n)]
        assert unroll(O.weighted_schedule(weights, sizes)) == simulate(weights, sizes)
    assert [i for i, _ in unroll(O.weighted_schedule([1.0] * 3, [3, 1, 4]))] == [0, 1, 2, 0, 2, 2, 0, 2]
    monkeypatch.undo()
    assert [len(x) for x in O.weighted_schedule([3.0, 1.0], [3 * 10**9, 10**9])] < [50, 1]
    runs, blocks = O.weighted_schedule([0.35, 0.2, 0.15, 0.3], [10**6] * 4)
    assert len(runs) <= 4 * O.MOST_CYCLE and len(blocks) <= 8
    assert sum(n for *_, n, _, _ in runs) + sum(n for _, n in blocks) == 4 * 10**6
    with pytest.raises(ValueError):
        O.weighted_schedule([0.0], [1])


@pytest.mark.parametrize("weights", [{}, {0: 2.0, 2: 0.5}, {0: 0.35, 1: 0.2, 2: 0.15}])
def test_weighted_round_robin(spark, monkeypatch, weights):
    monkeypatch.setattr(O, "MOST_CYCLE", 5)
    monkeypatch.setattr(O, "BLOCK_TICKS", 4)
    rows = [(s, s * 100 + k) for s, n in enumerate([3, 1, 14]) for k in range(n)]
    got = O.weighted_round_robin(spark.createDataFrame([*rows, (None, 7)], "s bigint, d bigint"), "s", ["d"], weights).orderBy("pos").collect()
    want = simulate([weights.get(i, 1.0) for i in range(3)], [3, 1, 14])
    assert [(r.s, r.d - 100 * r.s) for r in got] == want and [r.pos for r in got] == list(range(18))


def test_round_robin(spark):
    rows = [(s, k) for s, n in {2: 3, 5: 1, 9: 4}.items() for k in range(n)]
    got = O.round_robin(spark.createDataFrame(rows, "s bigint, d bigint"), "s", ["d"]).orderBy("pos").collect()
    assert [(r.s, r.d) for r in got] == sorted(rows, key=lambda r: (r[1], r[0])) and [r.pos for r in got] == list(range(8))
