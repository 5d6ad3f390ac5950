"""Operators on ordered streams.

DataFrames have no order, so every operator takes the order as columns and
gives it back as one. Sums and numbers along an order are made in two levels:
the order is cut into ranges, each range is summed on its own, and the few
range totals are summed over. No task sees the whole stream.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one range of the order, about, while there are at most so many ranges; 65,536 ranges keep 10^10 rows at 150,000 each.
ROWS_PER_RANGE, FIRST_RANGES, MOST_RANGES = 100_000, 1024, 1 << 16


def _range_of(df: DataFrame, key: str) -> Column:
    """A column that numbers ranges of ``key``, rising with it. Their number grows with the rows: one pass counts and finds up to FIRST_RANGES, and another finds more where they are wanted."""
    value = F.col(key).cast("double")

    def quantiles(parts: int) -> Column:
        return F.percentile_approx(value, [i / parts for i in range(1, parts)], min(4 * parts, 1 << 18))

    n, found = df.agg(F.count(F.lit(1)), quantiles(FIRST_RANGES)).first()
    parts = min(MOST_RANGES, max(4, n // ROWS_PER_RANGE))
    if parts > FIRST_RANGES:
        found = df.agg(quantiles(parts)).first()[0]
    elif found:
        found = [found[i * FIRST_RANGES // parts - 1] for i in range(1, parts)]
    cuts = sorted(set(found or []))
    if not cuts:
        return F.lit(0)
    if len(cuts) > 512:
        # the cuts as one sorted array; a place in it by halving
        listed = F.array(*map(F.lit, cuts))
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(listed, at + step - 1) <= value, F.lit(False)), at + step).otherwise(at))
    # a balanced tree of comparisons: log2(parts) of them for each row

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < cuts[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def prefix_sum(df: DataFrame, value: Column, order: Sequence[str], out: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before each row, in the order, within ``by``.

    The first order column must be a number and all of them together unique
    within ``by``. Null values count as 0.
    """
    ranged = df.withColumn("_mr_value", F.coalesce(value, F.lit(0))).withColumn("_mr_range", _range_of(df, order[0]))
    inside = Window.partitionBy(*by, "_mr_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_mr_range").agg(F.sum("_mr_value").alias("_mr_sum"))
    before = Window.partitionBy(*by).orderBy("_mr_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(b).alias(f"_mr_by{i}") for i, b in enumerate(by)], F.col("_mr_range").alias("_mr_r"), F.coalesce(F.sum("_mr_sum").over(before), F.lit(0)).alias("_mr_before"))
    same = F.col("_mr_range") == F.col("_mr_r")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_mr_by{i}"))
    joined = ranged.withColumn("_mr_inside", F.coalesce(F.sum("_mr_value").over(inside), F.lit(0))).join(totals, same)
    kept = [c for c in df.columns if c != out]
    return joined.select(*kept, (F.col("_mr_inside") + F.col("_mr_before")).alias(out))


def numbered(df: DataFrame, order: Sequence[str], out: str = "pos", by: Sequence[str] = ()) -> DataFrame:
    """Add a dense 0-based position."""
    return prefix_sum(df, F.lit(1).cast("bigint"), order, out, by)


def byte_budget(df: DataFrame, size: Column, order: Sequence[str], budget: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows up to the first that would pass the budget; sizes are never negative, so that is a prefix."""
    summed = prefix_sum(df, size, order, "_before", by)
    return summed.filter(F.col("_before") + F.coalesce(size, F.lit(0)) <= budget).drop("_before")


def skip_first(df: DataFrame, cursor: int, pos: str = "pos") -> DataFrame:
    """What is left of a stream of which ``cursor`` rows are done."""
    return df.filter(F.col(pos) >= cursor)


def round_robin(df: DataFrame, source: str, order: Sequence[str], out: str = "pos") -> DataFrame:
    """One row of each source per lap, sources in the order of ``source`` (a number); spent ones drop out.

    The place of the k-th row of a source is known from the sources' sizes:
    all rows of earlier laps, and the earlier sources that still have a k-th row.
    """
    in_turn = numbered(df, order, "_k", by=[source])
    # one row per source of the plan
    sizes = [(r[source], r["n"]) for r in df.groupBy(source).agg(F.count(F.lit(1)).alias("n")).orderBy(source).collect() if r[source] is not None]
    if not sizes:
        return in_turn.filter(F.col(source).isNotNull()).withColumnRenamed("_k", out)
    pairs = F.array(*[F.struct(F.lit(s).cast("bigint").alias("s"), F.lit(n).cast("bigint").alias("n")) for s, n in sizes])
    k, s = F.col("_k"), F.col(source)
    place = F.aggregate(pairs, F.lit(0).cast("bigint"), lambda acc, x: acc + F.least(x["n"], k) + ((x["s"] < s) & (x["n"] > k)).cast("bigint"))
    return in_turn.filter(s.isNotNull()).withColumn(out, place).drop("_k")


#: Ticks in which a cycle is looked for, and ticks of one block of a schedule without one.
MOST_CYCLE, BLOCK_TICKS = 20_000, 1_000_000


class _Turns:
    """Smooth weighted round-robin, tick by tick.

    Each tick adds its weight to the score of every active source, the highest
    score (the first of equals) is picked and pays the sum of the active
    weights; a source found spent when picked leaves, its score already
    charged.
    """

    def __init__(self, weights: Sequence[float], sizes: Sequence[int]):
        if any(not (w > 0 and w < float("inf")) for w in weights):
            raise ValueError("weights must be finite and above 0")
        self.weights, self.sizes = list(weights), list(sizes)
        self.score, self.used, self.active = [0.0] * len(weights), [0] * len(weights), list(range(len(weights)))
        self.whole = sum(self.weights)
        self.pos = 0

    def tick(self) -> int | None:
        """The source that gives the next row; None if the one picked leaves instead."""
        score, weights = self.score, self.weights
        for i in self.active:
            score[i] += weights[i]
        best = max(self.active, key=score.__getitem__)
        score[best] -= self.whole
        if self.used[best] >= self.sizes[best]:
            self.active.remove(best)
            self.whole = sum(weights[i] for i in self.active)
            return None
        self.used[best] += 1
        self.pos += 1
        return best

    def state(self) -> dict:
        return {"weights": self.weights, "sizes": self.sizes, "score": list(self.score), "used": list(self.used), "active": list(self.active), "pos": self.pos}

    @classmethod
    def of(cls, state: dict) -> _Turns:
        out = cls(state["weights"], state["sizes"])
        out.score, out.used, out.active, out.pos = list(state["score"]), list(state["used"]), list(state["active"]), state["pos"]
        out.whole = sum(out.weights[i] for i in out.active)
        return out


Run = tuple[int, int, int, int, int, int]


def weighted_schedule(weights: Sequence[float], sizes: Sequence[int]) -> tuple[list[Run], list[tuple[dict, int]]]:
    """Smooth weighted round-robin over sources of given sizes, as runs and blocks.

    Where the scores come back to what they were, a schedule of any length is a
    few cycles until a source leaves: runs (source, k_from, k_step, repeats,
    pos_from, pos_step) say that row ``k_from + j * k_step`` of the source
    stands at ``pos_from + j * pos_step`` for j < repeats. Sums of weights
    like 0.1 never come back as floating-point numbers; such a stretch is given
    by the state at the start of each BLOCK_TICKS ticks, from which executors
    repeat it. The runs of each stretch are at most MOST_CYCLE ticks, the
    stretches at most the sources, and the blocks one per BLOCK_TICKS rows.
    """
    turns = _Turns(weights, sizes)
    runs: list[Run] = []
    blocks: list[tuple[dict, int]] = []
    while turns.active:
        # until a source leaves
        stretch = len(turns.active)
        began, seen, log = turns.pos, {}, []
        single: list[Run] = []
        start = turns.state()
        while len(turns.active) == stretch and len(log) < MOST_CYCLE:
            key = tuple(turns.score)
            if key in seen:
                at, was = seen[key]
                cycle = log[at:]
                step = [u - w for u, w in zip(turns.used, was)]
                laps = min((sizes[i] - turns.used[i]) // step[i] for i in range(len(step)) if step[i])
                passed = [0] * len(step)
                for offset, i in enumerate(cycle):
                    if laps:
                        single.append((i, turns.used[i] + passed[i], step[i], laps, turns.pos + offset, len(cycle)))
                    passed[i] += 1
                turns.used = [u + laps * n for u, n in zip(turns.used, step)]
                turns.pos += laps * len(cycle)
                # less than a lap is left
                while len(turns.active) == stretch:
                    i = turns.tick()
                    if i is not None:
                        single.append((i, turns.used[i] - 1, 1, 1, turns.pos - 1, 1))
                break
            seen[key] = (len(log), list(turns.used))
            i = turns.tick()
            if i is not None:
                log.append(i)
                single.append((i, turns.used[i] - 1, 1, 1, turns.pos - 1, 1))
        if len(turns.active) < stretch:
            runs += single
            continue
        # no cycle: blocks from the start of the stretch on
        turns = _Turns.of(start)
        while len(turns.active) == stretch:
            first = turns.state()
            for _ in range(BLOCK_TICKS):
                if turns.tick() is None:
                    break
            blocks.append((first, turns.pos - first["pos"]))
    return runs, blocks


def _rows_of_blocks(spark: SparkSession, blocks: list[tuple[dict, int]], names: list[int]) -> DataFrame:
    """(_s, _k, _pos) of the ticks of blocks, repeated on the executors."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for state, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turns = _Turns.of(json.loads(state))
                picks, ks = np.empty(n, np.int64), np.empty(n, np.int64)
                for j in range(n):
                    i = turns.tick()
                    picks[j], ks[j] = names[i], turns.used[i] - 1
                yield pa.RecordBatch.from_arrays([pa.array(picks), pa.array(ks), pa.array(turns.pos - n + np.arange(n))], ["_s", "_k", "_pos"])

    # scores go through JSON as their shortest digits, which give the same numbers again
    rows = [(json.dumps(state), n) for state, n in blocks if n]
    return spark.createDataFrame(rows, "state string, n bigint").repartition(max(1, len(rows))).mapInArrow(run, "_s bigint, _k bigint, _pos bigint")


def weighted_round_robin(df: DataFrame, source: str, order: Sequence[str], weights: dict[int, float], out: str = "pos") -> DataFrame:
    """Interleave sources (numbers, in plan order) by smooth weighted round-robin; sources without a weight have 1.0."""
    spark = df.sparkSession
    sizes = {r[source]: r["n"] for r in df.groupBy(source).agg(F.count(F.lit(1)).alias("n")).collect() if r[source] is not None}
    names = sorted(sizes)
    runs, blocks = weighted_schedule([weights.get(s, 1.0) for s in names], [sizes[s] for s in names])
    in_turn = numbered(df.filter(F.col(source).isNotNull()), order, "_k", by=[source])
    # at most MOST_CYCLE rows per stretch, whatever the sizes
    table = spark.createDataFrame([(names[i], *rest) for i, *rest in runs], "_s bigint, _from bigint, _step bigint, _n bigint, _at bigint, _every bigint")
    off = F.col("_k") - F.col("_from")
    here = (F.col(source) == F.col("_s")) & (off >= 0) & (off % F.col("_step") == 0) & (off < F.col("_step") * F.col("_n"))
    kept = [c for c in df.columns if c != out]
    placed = in_turn.join(F.broadcast(table), here).select(*kept, (F.col("_at") + F.floor(off / F.col("_step")).cast("bigint") * F.col("_every")).alias(out))
    if not blocks:
        return placed
    ticks = _rows_of_blocks(spark, blocks, names).withColumnRenamed("_k", "_j")
    return placed.unionByName(in_turn.join(ticks, (F.col(source) == F.col("_s")) & (F.col("_k") == F.col("_j"))).select(*kept, F.col("_pos").alias(out)))
