"""Dealing files to phases. File lists are small and live on the driver."""

from __future__ import annotations

import heapq
import random
from collections.abc import Sequence

Shard = tuple[str, int]  # path, bytes


def contiguous(shards: Sequence[Shard], groups: int) -> list[list[Shard]]:
    """Cut a sorted list into contiguous groups of about equal size.

    A group closes once it has its share and every later group can still get a
    file, or when just one file for each later group is left. Files without
    sizes are dealt by number.
    """
    if groups < 1:
        raise ValueError("at least one group is needed")
    whole = sum(n for _, n in shards)
    if whole <= 0:
        cuts = [round(i * len(shards) / groups) for i in range(groups + 1)]
        return [list(shards[a:b]) for a, b in zip(cuts, cuts[1:])]
    out: list[list[Shard]] = [[]]
    held = 0
    for i, shard in enumerate(shards):
        out[-1].append(shard)
        held += shard[1]
        later, left = groups - len(out), len(shards) - i - 1
        if later and (left == later or held * groups >= whole and left >= later):
            out.append([])
            held = 0
    return out + [[] for _ in range(groups - len(out))]


def largest_first(shards: Sequence[Shard], groups: int) -> list[list[Shard]]:
    """Give each file, the largest first, to the group with least so far (the first of equals); groups sorted by path."""
    if groups < 1:
        raise ValueError("at least one group is needed")
    out: list[list[Shard]] = [[] for _ in range(groups)]
    load = [(0, g) for g in range(groups)]
    for path, size in sorted(shards, key=lambda s: -s[1]):
        held, g = heapq.heappop(load)
        out[g].append((path, size))
        heapq.heappush(load, (held + size, g))
    return [sorted(g) for g in out]


def first_share(files: Sequence[str], weight: float, total: int) -> list[str]:
    """The first ``weight * total`` files, at least one and at most all."""
    return list(files[: max(1, round(weight * total))])


def shuffled(items: Sequence, seed: int) -> list:
    """A seeded order, the same in every run."""
    out = list(items)
    random.Random(seed).shuffle(out)
    return out
