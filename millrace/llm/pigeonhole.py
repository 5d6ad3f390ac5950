"""Pairs of similar sets by a pigeonhole on their coordinates.

A text's fingerprint is the indicator vector of its word triples. Two sets of
similarity J lie at a Hamming distance of (|A| + |B|)(1 - J)/(1 + J), and at
most k = |A| - ceil(J|A|) ones of A are no ones of B. Split A's ones into blocks
of one each: of any k + 1 blocks at least one is shared, and likewise for B.
If both take their first k + 1 in one order of all triples, they share one of
those. The order is by rarity, counted over all sets in cells of a table of
bounded size, so that a block that many sets share (boilerplate) is taken only
where a set has little else. Triples that share a cell count as one, which
changes the order, the same for all sets, and loses nothing; each set is put in
order where it lies. Triples of one set only come first and meet nobody.

A join on blocks gives pairs with the number of blocks they share there and the
places of the last; with these the distance has a bound, and few pairs but the
similar ones pass it. No pair of enough similarity is lost, at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.words import binary_list, distinct, from_binary, portions, triples
from millrace.storage import materialize, release

#: Bits of a filter for each key, and the most bits of all (64 MB); a fuller filter lets more through and loses nothing.
BITS_PER_KEY, MOST_BITS, CHUNK_BITS = 8, 1 << 29, 1 << 19
#: Rows from which a triple is as common as any.
MOST_ROWS = 1 << 16


def triple_rows(texts: DataFrame, wanted: Broadcast | None = None) -> DataFrame:
    """(id, words) -> (key, id, size): the distinct triples of each text by hash, or those that may be in ``wanted`` (see bit_filter)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value if wanted is not None else None
        for batch in (part for whole in it for part in portions(whole, (1,))):
            values, offsets = distinct(*triples(*from_binary(batch.column(1), np.uint32)))
            n = np.diff(offsets)
            owner = np.repeat(np.arange(batch.num_rows), n)
            if bits is not None:
                keep = held(bits, values)
                values, owner = values[keep], owner[keep]
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), batch.column(0).take(pa.array(owner)), pa.array(n[owner].astype(np.int32))], ["key", "id", "size"])

    return texts.select("id", "words").mapInArrow(run, "key bigint, id bigint, size int")


def _counted(most: int):
    """mapInArrow over a range of (key, id, ...) sorted by key: adds ``n``, in how many sets the key stands, and leaves out keys of one set.

    A key of ``most`` rows or more, and the first and last of a range, which
    may go on in others, count as ``most``, everywhere the same. So hot keys
    are spread over ranges, and no more than ``most`` rows are held back.
    """

    def with_n(rows: pa.RecordBatch, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(n.astype(np.int32))], [*rows.schema.names, "n"])

    def crowded(rows: pa.RecordBatch) -> pa.RecordBatch:
        return with_n(rows, np.full(rows.num_rows, most))

    def whole_runs(parts: list[pa.RecordBatch], first: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        key = rows.column(0).to_numpy()
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lengths = np.diff(np.append(starts, len(key)))
        n = np.where(key[starts] == first, most, np.minimum(lengths, most))
        return with_n(rows, np.repeat(n, lengths)).filter(pa.array(np.repeat(n > 1, lengths)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = passing = None  # the first key of the range; a crowded key
        latest: list[pa.RecordBatch] = []  # rows of the latest key
        for batch in it:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            first = key[0] if first is None else first
            if passing is not None:
                end = int(np.searchsorted(key, passing, "right"))
                if end:
                    yield crowded(batch.slice(0, end))
                if end == batch.num_rows:
                    continue
                batch, key, passing = batch.slice(end), key[end:], None
            cut = int(np.searchsorted(key, key[-1]))
            done = [*latest, batch.slice(0, cut)] if cut else latest if latest and latest[0].column(0)[0].as_py() != key[0] else []
            if done:
                yield whole_runs(done, first)
                latest = []
            latest.append(batch.slice(cut))
            if sum(rows.num_rows for rows in latest) >= most:
                yield from map(crowded, latest)
                latest, passing = [], key[-1]
        yield from map(crowded, latest)

    return run


def _coded(n: np.ndarray) -> np.ndarray:
    """Counts as bytes in their order: exact up to 127, then in steps of a ninth."""
    return np.where(n < 128, n, 128 + np.minimum(8 * np.log2(np.maximum(n, 128) / 128), 127)).astype(np.uint8)


def rarity(texts: DataFrame) -> Broadcast:
    """(id, words) -> in how many sets the triples of each cell stand, as bytes (see _coded).

    A triple has the cell of its hash, of at most MOST_BITS / 8 cells (64 MB).
    A cell that counts 1 has one triple of one set.
    """
    most = texts.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0] // 4
    cells = CHUNK_BITS
    while cells < min(most, MOST_BITS // 8):
        cells *= 2

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in it for part in portions(whole, (0,))):
            values, _ = distinct(*triples(*from_binary(batch.column(0), np.uint32)))
            at, n = np.unique(_bit(values, cells).astype(np.int64), return_counts=True)
            chunks, starts = np.unique(at // CHUNK_BITS, return_index=True)
            steps, counts = np.diff(at, prepend=0), np.minimum(n, MOST_ROWS - 1).astype(np.uint16)
            steps[starts] = at[starts] % CHUNK_BITS
            bounds = np.append(starts, len(at))
            yield pa.RecordBatch.from_arrays([pa.array(chunks.astype(np.int32)), binary_list(steps.astype(np.uint32), bounds), binary_list(counts, bounds)], ["chunk", "steps", "counts"])

    def fill(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}  # the chunks of one task
        for batch in it:
            for chunk, steps, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                whole.setdefault(chunk, np.zeros(CHUNK_BITS, np.int64))[np.cumsum(np.frombuffer(steps, np.uint32))] += np.frombuffer(counts, np.uint16)
        for chunk, n in whole.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([_coded(n).tobytes()], pa.binary())], ["chunk", "codes"])

    placed = texts.select("words").mapInArrow(place, "chunk int, steps binary, counts binary").repartition("chunk")
    chunks = materialize(placed.mapInArrow(fill, "chunk int, codes binary"), "rarity")
    out = np.zeros(cells, np.uint8)
    for chunk, data in chunks.collect():
        out[chunk * CHUNK_BITS : (chunk + 1) * CHUNK_BITS] = np.frombuffer(data, np.uint8)
    release(chunks)
    return texts.sparkSession.sparkContext.broadcast(out)


def first_blocks(texts: DataFrame, least: float, rare: Broadcast | None = None) -> DataFrame:
    """(id, words) -> (key, id, size, place): the first k + 1 triples of each set in the order of rarity; those that no other set has there are left out but hold their places."""
    rare = rare or rarity(texts)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in it for part in portions(whole, (1,))):
            values, offsets = distinct(*triples(*from_binary(batch.column(1), np.uint32)))
            n = np.diff(offsets)
            owner = np.repeat(np.arange(batch.num_rows), n)
            code = rare.value[_bit(values, len(rare.value)).astype(np.int64)]
            order = np.lexsort((values, code, owner))
            place = np.arange(len(values)) - offsets[owner]
            keep = (place <= (n - np.ceil(least * n))[owner]) & (code[order] != 1)
            owner = owner[keep]
            yield pa.RecordBatch.from_arrays([pa.array(values[order][keep].view(np.int64)), batch.column(0).take(pa.array(owner)), pa.array(n[owner].astype(np.int32)), pa.array(place[keep].astype(np.int32))], ["key", "id", "size", "place"])

    parts = max(2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = texts.select("id", "words").mapInArrow(run, "key bigint, id bigint, size int, place int")
    counted = rows.repartitionByRange(parts, "key", "id").sortWithinPartitions("key").mapInArrow(_counted(MOST_ROWS), "key bigint, id bigint, size int, place int, n int")
    return counted.select("key", "id", "size", "place")


def near_enough(shared: Column, least: float) -> Column:
    """Whether sets of ``sa`` and ``sb`` members with at most ``shared`` in common may have the similarity: their distance is |A| + |B| - 2 * shared."""
    both = F.col("sa") + F.col("sb")
    return (both - 2 * shared) * (1 + least) <= both * (1 - least) + 1e-6


def meet(blocks: DataFrame, least: float) -> DataFrame:
    """(a, b), a < b, of sets that share a block and, by what they share there, may have a similarity of ``least``."""
    a = blocks.select("key", F.col("id").alias("a"), F.col("size").alias("sa"), F.col("place").alias("pa"))
    b = blocks.select(F.col("key").alias("k"), F.col("id").alias("b"), F.col("size").alias("sb"), F.col("place").alias("pb"))
    met = a.join(b, (F.col("key") == F.col("k")) & (F.col("a") < F.col("b")) & (F.least("sa", "sb") >= least * F.greatest("sa", "sb")))
    shared = met.groupBy("a", "b", "sa", "sb").agg(F.count(F.lit(1)).alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    # what else they share comes after the last of these in both, and after the first k + 1 of one
    after = F.least(F.col("sa") - F.col("pa"), F.col("sb") - F.col("pb")) - 1
    outside = F.greatest(F.ceil(least * F.col("sa")), F.ceil(least * F.col("sb"))) - 1
    return shared.filter(near_enough(F.col("c") + F.least(after, outside), least)).select("a", "b")


def candidates(texts: DataFrame, least: float) -> DataFrame:
    """(id, words) -> (a, b), a < b, distinct: among them all pairs of similarity ``least`` or more."""
    # the rows are cheaper made twice, for the cuts of the ranges and for the ranges, than kept on disk
    rare = rarity(texts)
    blocks = materialize(first_blocks(texts, least, rare), "blocks")
    rare.destroy()  # its files too
    pairs = materialize(meet(blocks, least), "candidates")
    release(blocks)
    return pairs


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(bits).bit_length() + 1)


def bit_filter(keys: DataFrame) -> Broadcast:
    """A bit set (at most MOST_BITS, whatever the number of keys) that has a bit for each of ``keys`` (key bigint)."""
    n = keys.agg(F.approx_count_distinct("key")).first()[0]
    bits = CHUNK_BITS
    while bits < min(BITS_PER_KEY * n, MOST_BITS):
        bits *= 2

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_bit(batch.column(0).to_numpy(), bits)).astype(np.int64))], ["bit"])

    def fill(rows: pa.Table) -> pa.Table:
        at = rows.column("bit").to_numpy()
        out = np.zeros(CHUNK_BITS, bool)
        out[at % CHUNK_BITS] = True
        return pa.table({"chunk": pa.array(at[:1] // CHUNK_BITS), "bits": pa.array([np.packbits(out).tobytes()], pa.binary())})

    # a bit is one row, so a chunk has at most CHUNK_BITS rows
    placed = keys.select("key").mapInArrow(place, "bit bigint").distinct()
    whole = np.zeros(bits // 8, np.uint8)
    chunks = materialize(placed.groupBy(F.floor(F.col("bit") / CHUNK_BITS)).applyInArrow(fill, "chunk bigint, bits binary"), "bits")
    for chunk, data in chunks.collect():
        whole[chunk * (CHUNK_BITS // 8) : (chunk + 1) * (CHUNK_BITS // 8)] = np.frombuffer(data, np.uint8)
    release(chunks)
    return keys.sparkSession.sparkContext.broadcast(whole)


def among(rows: DataFrame, key: str, wanted: Broadcast) -> DataFrame:
    """Rows whose ``key`` (bigint) may be in ``wanted`` (see bit_filter)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield batch.filter(pa.array(held(wanted.value, batch.column(key).to_numpy())))

    return rows.mapInArrow(run, rows.schema)


def held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit; all that were put in do."""
    at = _bit(keys, len(bits) * 8)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0
