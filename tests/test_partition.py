import random

import pytest

from millrace.operators import partition as P


def test_contiguous():
    sizes = [10, 10, 20, 20, 30, 30, 40, 40]
    groups = P.contiguous([(f"f{i}", n) for i, n in enumerate(sizes)], 4)
    assert [s for g in groups for s in g] == [(f"f{i}", n) for i, n in enumerate(sizes)]
    loads = [sum(n for _, n in g) for g in groups]
    assert max(loads) - min(loads) <= 40
    assert [len(g) for g in P.contiguous([(str(i), 0) for i in range(10)], 4)] == [2, 3, 3, 2]
    assert P.contiguous([], 3) == [[], [], []]
    assert [len(g) for g in P.contiguous([("a", 1)], 3)] == [1, 0, 0]
    with pytest.raises(ValueError):
        P.contiguous([], 0)


def test_contiguous_leaves_a_file_for_everyone():
    rng = random.Random(1)
    for _ in range(200):
        shards = [(str(i), rng.choice([1, 5, 500])) for i in range(rng.randint(4, 20))]
        groups = P.contiguous(shards, 4)
        assert [s for g in groups for s in g] == shards and all(groups)


def test_largest_first():
    rng = random.Random(2)
    shards = [(f"{i:03}", rng.randint(1, 100)) for i in range(40)]
    groups = P.largest_first(shards, 4)
    loads = [sum(n for _, n in g) for g in groups]
    assert sorted(s for g in groups for s in g) == shards and max(loads) - min(loads) <= 100
    assert all(g == sorted(g) for g in groups) and P.largest_first(shards, 4) == groups
    assert P.largest_first([("a", 5), ("b", 5), ("c", 1)], 2) == [[("a", 5), ("c", 1)], [("b", 5)]]


def test_shares_and_shuffle():
    files = [str(i) for i in range(10)]
    assert P.first_share(files, 0.0, 10) == ["0"] and len(P.first_share(files, 0.35, 10)) == 4 and len(P.first_share(files, 9, 10)) == 10
    assert P.shuffled(files, 3) == P.shuffled(files, 3) != files and sorted(P.shuffled(files, 3)) == files
