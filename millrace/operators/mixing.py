"""Mixing two or more streams."""

from __future__ import annotations

import pickle
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.order import numbered, prefix_sum

#: Draws of one chunk of a random schedule.
DRAWS = 1_000_000


def token_deficit_mix(df: DataFrame, stream: str, n_tokens: Column, order: Sequence[str], weights: dict[int, float], out: str = "pos") -> DataFrame:
    """Always take the stream that has given least for its weight, until the chosen one is spent.

    A row costs its tokens and an end token. Row by row this is a race; in
    closed form a row's key is what its stream gave before it over the weight,
    and all rows come in the order of (key, stream) up to the first place where
    a stream is asked for a row it doesn't have. A stream without rows ends the
    mixture at once.
    """
    spark = df.sparkSession
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    listed = spark.createDataFrame([(int(s), float(w)) for s, w in weights.items()], "_s bigint, _w double")
    cost = F.coalesce(n_tokens, F.lit(0)).cast("bigint") + 1
    known = df.join(F.broadcast(listed), F.col(stream) == F.col("_s"))
    keyed = prefix_sum(known, cost, order, "_pre", by=[stream]).withColumn("_key", F.col("_pre") / F.col("_w"))
    # one row per stream
    ends = known.groupBy("_s").agg(F.sum(cost).alias("total"))
    stop = listed.join(ends, "_s", "left").agg(F.min(F.struct((F.coalesce("total", F.lit(0)) / F.col("_w")).alias("key"), F.col("_s").alias("s"))).alias("stop"))
    stop_key, stop_stream = stop.first()["stop"]
    chosen = keyed.filter((F.col("_key") < stop_key) | ((F.col("_key") == stop_key) & (F.col(stream) < stop_stream)))
    return numbered(chosen, ["_key", stream], out).drop("_pre", "_key", "_s", "_w")


def observed_ratio(df: DataFrame, is_first: Column) -> DataFrame:
    """(n_rows, ratio): the share of rows of the first stream; 0.0 without rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.avg(F.when(is_first, 1.0).otherwise(0.0)), F.lit(0.0)).alias("ratio"))


def _schedule_chunks(first: int, second: int, ratio: float, seed: int, most: int | None) -> Iterator[tuple[bytes, int, int, int, int]]:
    """(state of the generator, draws, rows so far, first so far, second so far) of each chunk of draws."""
    twister = random.Random(seed)
    _, words, _ = twister.getstate()
    rng = np.random.RandomState()
    rng.set_state(("MT19937", np.array(words[:-1], np.uint32), words[-1]))
    a = b = emitted = 0
    a_left, b_left = True, True
    while (a_left or b_left) and not (most is not None and emitted >= most):
        before = (pickle.dumps((rng.get_state(), a_left, b_left)), DRAWS, emitted, a, b)
        _, a, b, a_left, b_left, emitted = _play(rng, a, b, a_left, b_left, emitted, first, second, ratio, most, DRAWS)
        yield before


def _play(rng, a, b, a_left, b_left, emitted, first, second, ratio, most, draws):
    """Run up to ``draws`` draws; the choice of each that gives a row (True: the first stream)."""
    picks = rng.random_sample(draws) < ratio
    out: list[np.ndarray] = []
    at = 0
    while at < draws and (a_left or b_left) and not (most is not None and emitted >= most):
        if not a_left or not b_left:  # the draw is forced
            size = (second - b) if not a_left else (first - a)
            n = min(size, draws - at, (most - emitted) if most is not None else draws)
            out.append(np.full(n, a_left, bool))
            a, b, at, emitted = a + n * a_left, b + n * (not a_left), at + n, emitted + n
            if at < draws and n == size:  # finds the stream spent
                at += 1
                a_left = b_left = False
            continue
        rest = picks[at:]
        ones = np.cumsum(rest)
        zeros = np.arange(1, len(rest) + 1) - ones
        # the first draw that asks a stream for a row it doesn't have
        a_out = int(np.searchsorted(ones, first - a + 1))
        b_out = int(np.searchsorted(zeros, second - b + 1))
        n = min(a_out, b_out, len(rest), (most - emitted) if most is not None else len(rest))
        out.append(rest[:n])
        taken = int(ones[n - 1]) if n else 0
        a, b, at, emitted = a + taken, b + n - taken, at + n, emitted + n
        if at < draws and not (most is not None and emitted >= most):
            if n == a_out:
                a_left = False
            else:
                b_left = False
            at += 1
    return (np.concatenate(out) if out else np.empty(0, bool)), a, b, a_left, b_left, emitted


def bernoulli_schedule(spark: SparkSession, first: int, second: int, ratio: float, seed: int, most: int | None = None) -> DataFrame:
    """(pos, side, k): the k-th row of side 0 or 1 stands at pos.

    One draw of the seeded generator for each step, also when the choice is
    forced or the drawn stream turns out spent. The draws are a sequence, but
    only the generator's state at every DRAWS draws is kept; executors repeat
    the draws of their chunks.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for state, draws, emitted, a, b in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                saved, a_left, b_left = pickle.loads(state)
                rng = np.random.RandomState()
                rng.set_state(saved)
                picks, *_ = _play(rng, a, b, a_left, b_left, emitted, first, second, ratio, most, draws)
                ones = np.cumsum(picks)
                k = np.where(picks, a + ones - 1, b + np.arange(1, len(picks) + 1) - ones - 1)
                yield pa.RecordBatch.from_arrays([pa.array(emitted + np.arange(len(picks))), pa.array((~picks).astype(np.int32)), pa.array(k.astype(np.int64))], ["pos", "side", "k"])

    chunks = list(_schedule_chunks(first, second, ratio, seed, most))
    return spark.createDataFrame(chunks, "state binary, draws bigint, emitted bigint, a bigint, b bigint").repartition(max(1, len(chunks))).mapInArrow(run, "pos bigint, side int, k bigint")


def bernoulli_mix(first: DataFrame, second: DataFrame, order: Sequence[str], ratio: float = 0.75, seed: int = 42, most: int | None = None, out: str = "pos") -> DataFrame:
    """Mix two streams of the same columns by seeded random choice; adds ``out`` and ``side`` (0 or 1)."""
    schedule = bernoulli_schedule(first.sparkSession, first.count(), second.count(), ratio, seed, most)
    rows = numbered(first, order, "_k").withColumn("_side", F.lit(0)).unionByName(numbered(second, order, "_k").withColumn("_side", F.lit(1)))
    return rows.join(schedule, (F.col("_side") == F.col("side")) & (F.col("_k") == F.col("k"))).withColumnRenamed("pos", "_pos").withColumn(out, F.col("_pos")).drop("_k", "_side", "_pos", "k")
