"""Evaluation prompts that stand in corpus texts (greedy string tiling).

Both sides are words. Runs of ``least`` words are hashed by a running
Karp-Rabin polynomial; hits of a text's hashes in the hash table of the
prompts are the seeds. Seeds that follow each other in both are one match.
Where a text and a prompt share seeds, the longest match that overlaps no
earlier tile is marked, again and again, until none of at least ``least`` words
is left; a match that a tile cuts leaves its free parts. A tile is thus a run of
words that stands in both without a gap, and the tiles of a prompt may lie in
the text in any order; what they cover of the prompt has a threshold.

The prompts are a stated set of a size that doesn't grow with the corpus (240
at every scale). Their bytes are counted first: up to ITEM_BYTES of them come to
the driver at a time, and each text is read once for each such part. Nothing of
the corpus is shuffled. A text and a prompt that both repeat a phrase have as
many seeds as pairs of its occurrences, at most the product of their words.

Results: null, empty and short texts and prompts have no tile; a prompt that
stands under several ids is reported under each; a repeated row is reported
once; coverage is the share of the prompt's words under tiles.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.words import hash_words, slices, word_lists
from millrace.storage import spread

LEAST_WORDS = 10
#: UTF-8 bytes of the prompts that one table holds, about.
ITEM_BYTES = 16_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def rolling(hashes: np.ndarray, least: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of the ``least`` words from each position on."""
    n = len(hashes) - least + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, out = hashes.astype(np.uint64), np.zeros(n, np.uint64)
    for j in range(least):
        out = out * _BASE + h[j : j + n]
    return out


class SeedTable:
    """Karp-Rabin hashes of every run of ``least`` words of the prompts."""

    def __init__(self, prompts: list[list[str]], least: int):
        runs = [rolling(hash_words(words), least) for words in prompts]
        n = np.array([len(r) for r in runs], np.int64)
        every = np.concatenate([*runs, np.empty(0, np.uint64)])
        order = np.argsort(every, kind="stable")
        self.prompt = np.repeat(np.arange(len(runs)), n)[order]
        self.place = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))[order]
        self.keys, self.first, self.many = np.unique(every[order], return_index=True, return_counts=True)

    def hits(self, runs: np.ndarray) -> np.ndarray:
        """Positions of ``runs`` that stand in the table."""
        if not len(self.keys) or not len(runs):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, runs), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] == runs)

    def seeds(self, runs: np.ndarray, at: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(text, prompt, places in the words, places in the prompt) of each text and prompt that share runs, from places ``at`` of known runs."""
        key = np.searchsorted(self.keys, runs[at])
        many = self.many[key]
        entry = np.repeat(self.first[key] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        text, place = np.repeat(owner, many), np.repeat(at, many)
        order = np.lexsort((self.prompt[entry], text))
        text, place, entry = text[order], place[order], entry[order]
        prompt = self.prompt[entry]
        cuts = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (prompt[1:] != prompt[:-1]))) if len(text) else np.empty(0, np.int64)
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(text)]):
            yield int(text[lo]), int(prompt[lo]), place[lo:hi], self.place[entry[lo:hi]]


def matches(text: list[str], prompt: list[str], at_text: np.ndarray, at_prompt: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal matches (place in text, place in prompt, words) made of seeds that follow each other in both.

    Seeds have the same hash; the words themselves are compared here.
    """
    if not len(at_text):
        return []
    diagonal = at_text - at_prompt
    order = np.lexsort((at_text, diagonal))
    d, t = diagonal[order], at_text[order]
    starts = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1] + 1)))
    out = []
    for first, seeds, shift in zip(t[starts].tolist(), np.diff(np.append(starts, len(t))).tolist(), d[starts].tolist()):
        end, begin = first + seeds + least - 1, first
        for k in range(first, end + 1):
            if k == end or text[k] != prompt[k - shift]:
                if k - begin >= least:
                    out.append((begin, begin - shift, k - begin))
                begin = k + 1
    return out


def greedy_tiles(text: list[str], prompt: list[str], at_text: np.ndarray, at_prompt: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in text, place in prompt, words), longest first, of equals in the order of the text, none overlapping another on either side."""
    queue = [(-n, t, p) for t, p, n in matches(text, prompt, at_text, at_prompt, least)]
    heapq.heapify(queue)
    marked_text, marked_prompt = bytearray(len(text)), bytearray(len(prompt))
    tiles = []
    while queue:
        n, t, p = heapq.heappop(queue)
        n = -n
        if marked_text.find(1, t, t + n) < 0 and marked_prompt.find(1, p, p + n) < 0:
            marked_text[t : t + n] = marked_prompt[p : p + n] = b"\1" * n
            tiles.append((t, p, n))
            continue
        free = 0
        for k in range(n + 1):
            if k == n or marked_text[t + k] or marked_prompt[p + k]:
                if k - free >= least:
                    heapq.heappush(queue, (free - k, t + free, p + free))
                free = k + 1
    return tiles


def tiles_of(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "id", prompt: str = "prompt", least: int = LEAST_WORDS, least_coverage: float = 0.0) -> DataFrame:
    """(item_id, doc_id, tiles, words, longest, coverage), one row for each text and item with a tile and at least the coverage."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("i"), F.col(prompt).alias("p")).filter("i is not null and p != ''").distinct()
    parts = max(1, -(-(items.agg(F.sum(F.octet_length("p"))).first()[0] or 0) // ITEM_BYTES))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"item_id string, doc_id {id_type}, tiles int, words int, longest int, coverage double"
    found = None
    for k in range(parts):
        ids: dict[str, list[str]] = defaultdict(list)
        for i, p in items.filter(F.pmod(F.xxhash64("p"), F.lit(parts)) == k).collect():  # about ITEM_BYTES
            ids[p].append(i)
        texts = sorted(ids)
        words, offsets = word_lists(texts)
        by_words: dict[tuple[str, ...], list[str]] = defaultdict(list)
        for n, p in enumerate(texts):
            run = tuple(words[offsets[n] : offsets[n + 1]])
            if len(run) >= least:
                by_words[run] += ids[p]
        block = sorted(by_words)
        part = docs.mapInArrow(_tiler(docs.sparkSession, [list(r) for r in block], [sorted(set(by_words[r])) for r in block], least), schema)
        found = part if found is None else found.unionByName(part)
    # a row for each distinct (item, document), even if the document's row is repeated
    whole = found.groupBy("item_id", "doc_id").agg(*[F.max(c).alias(c) for c in ("tiles", "words", "longest", "coverage")])
    return whole.filter(F.col("coverage") >= least_coverage) if least_coverage > 0 else whole


def _tiler(spark: SparkSession, prompts: list[list[str]], names: list[list[str]], least: int):
    shared = spark.sparkContext.broadcast((prompts, names))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prompts, names = shared.value
        table = SeedTable(prompts, least)
        for batch in it:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            rows: list[tuple] = []
            places: list[int] = []
            for lo, hi in slices(texts):
                words, offsets = word_lists(texts[lo:hi])
                runs = rolling(hash_words(words), least)
                at = table.hits(runs)
                owner = np.searchsorted(offsets, at, "right") - 1
                inside = at + least <= offsets[owner + 1]
                for d, k, at_text, at_prompt in table.seeds(runs, at[inside], owner[inside]):
                    tiles = greedy_tiles(words[offsets[d] : offsets[d + 1]], prompts[k], at_text - offsets[d], at_prompt, least)
                    if tiles:
                        covered = sum(n for _, _, n in tiles)
                        for name in names[k]:
                            places.append(lo + d)
                            rows.append((name, len(tiles), covered, max(n for _, _, n in tiles), covered / len(prompts[k])))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), doc_ids.take(pa.array(places, pa.int64())), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.float64())],
                names=["item_id", "doc_id", "tiles", "words", "longest", "coverage"],
            )

    return run


def leaked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 7 over the whole of documents and contract_cases_v1, with coverage."""
    return tiles_of(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), spark.read.parquet(f"{sf_dir}/contract_cases_v1.parquet"))


def leaked_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked(spark, sf_dir).select("item_id", "doc_id")


def leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each leaked case with the number of documents and the most that one of them covers."""
    return leaked(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("longest").alias("longest"), F.round(F.max("coverage"), 6).alias("coverage"))
