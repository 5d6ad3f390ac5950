"""Texts by hash, and the exact similarity of pairs of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import distinct, from_binary, hamming, portions, triples


def hash_as_read(c: Column) -> Column:
    """Trimmed, in lower case, without a leading ``sha256:``."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"\A\s+|\s+\z", "")), r"\Asha256:", "")


def split_as_read(c: Column) -> Column:
    """Trimmed, in lower case."""
    return F.lower(F.regexp_replace(c, r"\A\s+|\s+\z", ""))


def texts_of(upstream: DataFrame, hashes: DataFrame) -> DataFrame:
    """``hashes`` (hash in hex, and flags; distinct) with the text of each, one row per hash that has a text.

    Copies are merged before they are shuffled, so a text that holds a third
    of all rows comes as one row of each task.
    """
    hashed = upstream.filter(F.col("text").isNotNull()).select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("_h"), "text")
    named = hashed.groupBy("_h").agg(F.first("text").alias("text"))
    wanted = hashes.withColumn("_w", F.unhex("hash")).filter(F.col("_w").isNotNull())
    flags = [c for c in hashes.columns if c != "hash"]
    return named.join(wanted, F.col("_h") == F.col("_w")).select(F.col("_h").alias("hash"), "text", *flags)


def similar(pairs: DataFrame, least: float) -> DataFrame:
    """(a, b, words_a, words_b) -> (a, b, similarity) of those with at least ``least``.

    With A and B the sets of word triples as indicator vectors, H = |A ^ B| is
    their Hamming distance, and the similarity is (|A| + |B| - H) / (|A| + |B| + H).
    """
    kind = pairs.schema["a"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for batch in portions(whole, (2, 3)):
                sets = [distinct(*triples(*from_binary(batch.column(k), np.uint32))) for k in (2, 3)]
                ones = np.diff(sets[0][1]) + np.diff(sets[1][1])
                distance = hamming(*sets)
                s = np.where((np.diff(sets[0][1]) > 0) & (np.diff(sets[1][1]) > 0), (ones - distance) / np.maximum(ones + distance, 1), 0.0)
                keep = pa.array(s >= least)
                yield pa.RecordBatch.from_arrays([pc.filter(batch.column(0), keep), pc.filter(batch.column(1), keep), pa.array(s[s >= least])], ["a", "b", "similarity"])

    return pairs.select("a", "b", "words_a", "words_b").mapInArrow(run, f"a {kind}, b {kind}, similarity double")


def with_words(pairs: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Join the word hashes of both ends to (a, b)."""
    left = texts.select(F.col(key).alias("_a"), F.col("words").alias("words_a"))
    right = texts.select(F.col(key).alias("_b"), F.col("words").alias("words_b"))
    return pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b")).select("a", "b", "words_a", "words_b")
