import random
from collections import Counter, defaultdict

import pytest

from millrace.llm import packing as P


def one_by_one(lengths, capacity):
    """Best-fit decreasing, item by item: how many bins hold how much."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(capacity - n)
    return Counter(capacity - r for r in room)


def check(lengths, capacity):
    plan = P.best_fit_plan(Counter(lengths), capacity)
    bins, fill, ranks = defaultdict(list), {}, defaultdict(set)
    for size, lo, hi, first, per_bin, place, filled in plan:
        for k in range(lo, hi):
            b, slot = divmod(k - lo, per_bin)
            bins[first + b].append((place + slot * size, size))
            assert fill.setdefault(first + b, filled) == filled
            assert k not in ranks[size]
            ranks[size].add(k)
    assert {s: len(r) for s, r in ranks.items()} == dict(Counter(lengths))
    for b, items in bins.items():
        at = 0
        for place, size in sorted(items):
            assert place == at
            at += size
        assert at == fill[b] <= capacity
    assert Counter(fill.values()) == one_by_one(lengths, capacity)
    return plan


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 20, 100])
    check([rng.randint(1, capacity) for _ in range(rng.randint(0, 300))], capacity)


def test_plan_does_not_grow_with_the_rows():
    rng = random.Random(1)
    counts = {s: rng.randint(1, 50) for s in range(1, 2049)}
    small = len(P.best_fit_plan(counts))
    large = len(P.best_fit_plan({s: n * 1_000_000 for s, n in counts.items()}))
    assert large < 60_000 and large < 4 * small + 20_000


def test_tree():
    tree = P._RoomTree(10)
    assert tree.tightest(0) is None
    tree.set(4, True)
    tree.set(9, True)
    assert [tree.tightest(r) for r in (0, 4, 5, 9, 10)] == [4, 4, 9, 9, None]
    tree.set(4, False)
    assert tree.tightest(0) == 9


def test_wrong_lengths():
    with pytest.raises(ValueError):
        P.best_fit_plan({0: 1}, 4)


def test_records(spark, monkeypatch):
    monkeypatch.setattr(P, "ITEMS_PER_BUCKET", 7)
    rng = random.Random(3)
    rows = [(i, "x" * rng.choice([0, 1, 3, 5, 9, 10, 11, 40])) for i in range(120)] + [(5, "yyy"), (5, "yyy"), (None, "ab"), (7, None), (8, "ğ😀"), (9, " ")]
    df = spark.createDataFrame([(i, t, "other", 1) for i, t in rows], "k bigint, text string, fill string, sequence int")
    got = P.pack(df, "text", ["k"], 10).collect()
    assert sum(r.length for r in got) == sum(len(t) for _, t in rows if t)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence].append(r)
    assert sorted(bins) == list(range(len(bins)))
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r.place):
            assert r.place == at
            at += r.length
        assert {r.fill for r in b} == {at} and at <= 10
    lengths = [n for _, t in rows if t for n in [10] * (len(t) // 10) + [len(t) % 10] * (len(t) % 10 > 0)]
    assert Counter(b[0].fill for b in bins.values()) == one_by_one(lengths, 10)
    parts = sorted((r.piece, r.start, r.length) for r in got if r.k == 119)
    assert [p for p, *_ in parts] == list(range(len(parts)))
    assert sorted(map(repr, got)) == sorted(map(repr, P.pack(df.repartition(3), "text", ["k"], 10).collect()))


def test_nothing(spark):
    assert P.pack(spark.createDataFrame([(1, None)], "k bigint, text string"), "text", ["k"]).count() == 0
