"""Filling fixed-capacity sequences with records (best-fit decreasing).

Best-fit decreasing looks only at lengths, and lengths up to the capacity C
take at most C values. The histogram of lengths (at most C rows, whatever the
corpus) is therefore all that the sequential part needs: the driver runs the
method over it with a segment tree on remaining capacities, and the result is
a plan of runs "items of length s, ranks a to b, go to bins x to y at place
p". The plan's size depends on C alone. Records find their place by a join of
their rank among equal lengths with the plan, so no text and no list of
records leaves the executors.

Results: rows with null or empty text have no piece; a record longer than C
gives full pieces and one rest; repeated rows are packed as often as they
stand in the table; an empty table gives no rows.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CAPACITY = 2048
#: Items that one task ranks at most, on average, in one length class.
ITEMS_PER_BUCKET = 100_000


class _RoomTree:
    """Segment tree over remaining capacities 0..capacity: is a bin with that much room open?"""

    def __init__(self, capacity: int):
        self.base = 1
        while self.base < capacity + 1:
            self.base *= 2
        self.any = bytearray(2 * self.base)

    def set(self, room: int, is_open: bool) -> None:
        at = room + self.base
        self.any[at] = is_open
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of at least ``least`` with an open bin."""
        at = least + self.base
        if self.any[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.base:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.base
            at //= 2
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: count}``.

    Rows (length, rank_from, rank_to, bin_from, per_bin, place, fill): the item
    of rank k (0-based, rank_from <= k < rank_to) among those of that length
    lies in bin ``bin_from + (k - rank_from) // per_bin`` at place ``place +
    (k - rank_from) % per_bin * length``; ``fill`` is what the bin holds in
    the end. The result is that of placing items one by one: an item that went
    into the tightest bin leaves room r - s, and while that still takes an
    item of length s it is the tightest bin again.
    """
    tree = _RoomTree(capacity)
    open_bins: dict[int, deque[tuple[int, int]]] = {}
    moves: list[tuple[int, int, int, int, int, int]] = []
    next_bin = 0

    def put(room: int, first: int, count: int) -> None:
        if count:
            open_bins.setdefault(room, deque()).append((first, count))
            tree.set(room, True)

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        if size < 1 or size > capacity:
            raise ValueError(f"length {size} is outside 1..{capacity}")
        while left:
            room = tree.tightest(size)
            if room is None:
                per_bin = capacity // size
                first, count, room = next_bin, -(-left // per_bin), capacity
                next_bin += count
            else:
                per_bin = room // size
                first, held = open_bins[room].popleft()
                count = min(held, -(-left // per_bin))
                if held > count:
                    open_bins[room].appendleft((first + count, held - count))
                if not open_bins[room]:
                    tree.set(room, False)
            taken = min(left, count * per_bin)
            moves.append((size, rank, rank + taken, first, per_bin, capacity - room))
            full = taken // per_bin
            put(room - per_bin * size, first, full)
            if full < count:
                put(room - (taken - full * per_bin) * size, first + full, 1)
            rank, left = rank + taken, left - taken
    return _with_fill(moves, open_bins, capacity)


def _with_fill(moves, open_bins, capacity):
    """Cut each move where the final fill of its bins changes."""
    import bisect

    ranges = sorted((first, first + count, capacity - room) for room, held in open_bins.items() for first, count in held)
    starts = [r[0] for r in ranges]
    plan = []
    for size, lo, hi, first, per_bin, place in moves:
        last = first + -(-(hi - lo) // per_bin)
        at = bisect.bisect_right(starts, first) - 1
        while first < last:
            end = min(last, ranges[at][1])
            upto = min(hi, lo + (end - first) * per_bin)
            plan.append((size, lo, upto, first, per_bin, place, ranges[at][2]))
            first, lo, at = end, upto, at + 1
    return plan


def pack(records: DataFrame, text: str, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Place every non-empty text of ``records`` into sequences of ``capacity`` code points.

    Columns: sequence, the ``keys``, piece (0-based), start (first code point
    of the piece in its record), length, place (offset in the sequence), fill
    (code points in the sequence).
    """
    spark = records.sparkSession
    length = F.length(F.col(text)).cast("bigint")
    sized = records.select(*keys, length.alias("_chars")).filter(F.col("_chars") > 0)
    pieces = sized.select(
        *keys,
        F.col("_chars"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_chars") - 1) / capacity).cast("bigint"))).alias("piece"),
    ).select(
        *keys,
        "piece",
        (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("bigint"), F.col("_chars") - F.col("piece") * capacity).alias("length"),
    )
    # At most `capacity` rows, whatever the corpus.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit_plan(histogram, capacity)
    plan_df = spark.createDataFrame(plan, "length bigint, rank_from bigint, rank_to bigint, bin_from bigint, per_bin bigint, base bigint, fill bigint")

    ranked = rank_in_class(pieces, "length", [*keys, "piece"], sum(histogram.values()))
    into = F.col("_rank") - F.col("p.rank_from")
    return (
        ranked.alias("i")
        .join(F.broadcast(plan_df.alias("p")), (F.col("i.length") == F.col("p.length")) & (F.col("_rank") >= F.col("p.rank_from")) & (F.col("_rank") < F.col("p.rank_to")))
        .select(
            (F.col("p.bin_from") + F.floor(into / F.col("p.per_bin"))).cast("bigint").alias("sequence"),
            *[F.col(f"i.{k}") for k in keys],
            F.col("i.piece"),
            F.col("i.start"),
            F.col("i.length"),
            (F.col("p.base") + into % F.col("p.per_bin") * F.col("i.length")).alias("place"),
            F.col("p.fill"),
        )
    )


def rank_in_class(items: DataFrame, cls: str, keys: list[str], n_items: int) -> DataFrame:
    """Add ``_rank``, a dense 0-based rank within each value of ``cls``.

    A class may hold most rows, so it is cut into hash buckets: rows are
    numbered within (class, bucket) and offset by the running count of the
    class's earlier buckets. The order is that of a hash of the keys and then
    the keys, so a repeated task gives the same ranks.
    """
    buckets = max(1, -(-n_items // ITEMS_PER_BUCKET))
    hashed: Column = F.xxhash64(*keys)
    items = items.withColumn("_hash", hashed).withColumn("_bucket", F.pmod(F.col("_hash"), F.lit(buckets)))
    offsets = (
        items.groupBy(cls, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy(cls).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .select(F.col(cls).alias("_cls"), F.col("_bucket").alias("_b"), F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    numbered = items.withColumn("_row", F.row_number().over(Window.partitionBy(cls, "_bucket").orderBy("_hash", *keys)))
    return (
        numbered.join(offsets, (F.col(cls) == F.col("_cls")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_rank", F.col("_before") + F.col("_row") - 1)
        .drop("_cls", "_b", "_hash", "_bucket", "_before", "_row")
    )


def pack_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 1 over the whole of upstream_identity_v1."""
    upstream = spark.read.parquet(f"{sf_dir}/upstream_identity_v1.parquet").select(
        F.col("source.repo").alias("repo"), F.col("source.revision").alias("revision"), F.col("source.config").alias("config"), F.col("source.split").alias("split"), "ordinal", "text"
    )
    return pack(upstream, "text", ["repo", "revision", "config", "split", "ordinal"])
