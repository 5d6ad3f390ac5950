"""Packing token sequences into chunks of one length.

Documents follow each other in an order; each gives its tokens and an end
token, and the stream is cut every ``length`` tokens. The place of a document
in the stream is a prefix sum, from which every count follows without tokens;
where tokens are wanted, a document is cut into one slice per chunk that it
touches, and the slices of a chunk are joined. Nothing is exploded by token.

A document without tokens gives nothing, not even an end token, but counts as
processed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.order import prefix_sum
from millrace.storage import materialize

LENGTH = 1024


def code_points(text: Column) -> Column:
    """The tokenizer of tests: one token for each code point."""
    return F.when(F.length(text) > 0, F.transform(F.split(text, ""), lambda c: F.ascii(c))).otherwise(F.array().cast("array<int>"))


def placed(docs: DataFrame, n_tokens: Column, order: Sequence[str], budget: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Add ``pre`` (tokens before the document) and ``given`` (tokens it gives, end token included, cut at the budget).

    Documents that start at or after the budget are not processed and left out.
    """
    cost = F.when(F.coalesce(n_tokens, F.lit(0)) > 0, n_tokens + 1).otherwise(0).cast("bigint")
    out = prefix_sum(docs, cost, order, "pre", by).withColumn("given", cost)
    if budget is not None:
        if budget < 0:
            raise ValueError("a budget can't be below 0")
        out = out.filter(F.col("pre") < budget).withColumn("given", F.least(F.col("given"), F.lit(budget) - F.col("pre")))
    return out


def slices(placed_docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row for each document and chunk it touches: adds chunk_id, skip (tokens of the document before), offset (in the chunk) and n."""
    some = placed_docs.filter(F.col("given") > 0)
    first = F.floor(F.col("pre") / length).cast("bigint")
    last = F.floor((F.col("pre") + F.col("given") - 1) / length).cast("bigint")
    cut = some.withColumn("chunk_id", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("pre"), F.col("chunk_id") * length)
    end = F.least(F.col("pre") + F.col("given"), (F.col("chunk_id") + 1) * length)
    return cut.withColumn("skip", start - F.col("pre")).withColumn("offset", start - F.col("chunk_id") * length).withColumn("n", end - start)


def chunk_sources(cut: DataFrame, source: str, by: Sequence[str] = ()) -> DataFrame:
    """(chunk_id, source, tokens, first_offset) with null sources as 'unknown'."""
    return cut.groupBy(*by, "chunk_id", F.coalesce(F.col(source), F.lit("unknown")).alias("source")).agg(F.sum("n").alias("tokens"), F.min("offset").alias("first_offset"))


def chunk_majority(cut: DataFrame, source: str, by: Sequence[str] = ()) -> DataFrame:
    """(chunk_id, valid_length, source): the source with most tokens, of equals the one that comes first in the chunk."""
    parts = chunk_sources(cut, source, by)
    return parts.groupBy(*by, "chunk_id").agg(F.sum("tokens").alias("valid_length"), F.min_by("source", F.struct(-F.col("tokens"), F.col("first_offset"))).alias("source"))


def source_tokens(cut: DataFrame, source: str) -> DataFrame:
    """(source, n_tokens, n_chunks): tokens with end tokens, and chunks in which the source has the majority."""
    tokens = cut.groupBy(F.coalesce(F.col(source), F.lit("unknown")).alias("source")).agg(F.sum("n").alias("n_tokens"))
    chunks = chunk_majority(cut, source).groupBy(F.col("source").alias("s")).agg(F.count(F.lit(1)).alias("n_chunks"))
    return tokens.join(chunks, F.col("source") == F.col("s"), "left").select("source", "n_tokens", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"))


def pack(docs: DataFrame, tokens: Column, source: str, order: Sequence[str], length: int = LENGTH, end: int = 2, pad: int = 2, budget: int | None = None, vocabulary: int | None = None) -> DataFrame:
    """(chunk_id, tokens, valid_length, token_sources, source), tokens and source names padded to ``length`` (null names on padding).

    The order must be unique. Tokens are made once and kept; places, lengths
    and majorities come from their numbers alone, and each document is cut in
    one pass over its tokens. A token outside 0..vocabulary-1 is an error.
    """
    ids = docs.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.coalesce(F.col(source), F.lit("unknown")).alias("source"), tokens.alias("_tokens"))
    if vocabulary is not None:
        wrong = F.exists("_tokens", lambda t: (t < 0) | (t >= vocabulary))
        ids = ids.withColumn("_tokens", F.when(wrong, F.raise_error(F.lit("a token is outside the vocabulary"))).otherwise(F.col("_tokens")))
    keys = [f"_o{i}" for i in range(len(order))]
    kept = materialize(ids.select(*keys, "source", F.size("_tokens").cast("bigint").alias("_count"), F.concat("_tokens", F.array(F.lit(end))).alias("_all")), "tokens")
    place = placed(kept.select(*keys, "source", "_count"), F.col("_count"), keys, budget)
    majority = chunk_majority(slices(place, length), "source").select(F.col("chunk_id").alias("c"), "valid_length", "source")
    spot = place.filter(F.col("given") > 0).select(*[F.col(k).alias(f"{k}_") for k in keys], "pre", "given")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    stop = F.col("pre") + F.col("given")

    def part(c: Column) -> Column:
        start = F.greatest(F.col("pre"), c * length)
        n = (F.least(stop, (c + 1) * length) - start).cast("int")
        return F.struct(c.alias("chunk_id"), (start - c * length).cast("int").alias("offset"), F.slice("_all", (start - F.col("pre") + 1).cast("int"), n).alias("piece"))

    chunks = F.sequence(F.floor(F.col("pre") / length).cast("bigint"), F.floor((stop - 1) / length).cast("bigint"))
    parts = kept.join(spot, same).select(F.explode(F.transform(chunks, part)).alias("x"), F.col("source").alias("s")).select("x.chunk_id", "x.offset", "x.piece", "s")
    whole = parts.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("offset", "piece", "s"))).alias("p"))
    filled = whole.join(majority, F.col("chunk_id") == F.col("c"))
    lack = (F.lit(length) - F.col("valid_length")).cast("int")
    return filled.select(
        "chunk_id",
        F.concat(F.flatten(F.transform("p", lambda x: x["piece"])), F.array_repeat(F.lit(pad), lack)).alias("tokens"),
        "valid_length",
        F.concat(F.flatten(F.transform("p", lambda x: F.array_repeat(x["s"], F.size(x["piece"])))), F.array_repeat(F.lit(None).cast("string"), lack)).alias("token_sources"),
        "source",
    )


def training_examples(chunks: DataFrame) -> DataFrame:
    """Packed chunks as training rows: labels are the tokens, -100 on padding; the mask is 1 on tokens."""
    valid = F.col("valid_length")
    return chunks.select(
        "chunk_id",
        F.col("tokens").alias("input_ids"),
        F.transform("tokens", lambda t, i: F.when(i < valid, t).otherwise(-100)).alias("labels"),
        F.transform("tokens", lambda t, i: F.when(i < valid, 1).otherwise(0)).alias("attention_mask"),
        "token_sources",
        "source",
    )


def per_file_chunks(docs: DataFrame, n_tokens: Column, file: str, order: Sequence[str], length: int = LENGTH) -> DataFrame:
    """(file, chunks, kept_tail): every file is packed on its own, and a tail is kept from half a chunk on."""
    total = F.sum(F.when(F.coalesce(n_tokens, F.lit(0)) > 0, n_tokens + 1).otherwise(0).cast("bigint"))
    return docs.groupBy(file).agg(total.alias("t")).select(
        file, (F.floor(F.col("t") / length) + (F.col("t") % length >= length // 2).cast("int")).cast("bigint").alias("chunks"), ((F.col("t") % length > 0) & (F.col("t") % length >= length // 2)).alias("kept_tail")
    )


def pack_per_file(docs: DataFrame, tokens: Column, file: str, order: Sequence[str], length: int = LENGTH, end: int = 2, pad: int = 2) -> DataFrame:
    """(file, chunk, tokens): every file packed on its own; a tail is padded and kept from half a chunk on."""
    ids = docs.select(F.col(file).alias("file"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], tokens.alias("_tokens"))
    keys = [f"_o{i}" for i in range(len(order))]
    kept = materialize(ids.select("file", *keys, F.size("_tokens").cast("bigint").alias("_count"), F.concat("_tokens", F.array(F.lit(end))).alias("_all")), "tokens")
    place = placed(kept.select("file", *keys, "_count"), F.col("_count"), keys, by=["file"]).filter(F.col("given") > 0)
    spot = place.select(F.col("file").alias("_f"), *[F.col(k).alias(f"{k}_") for k in keys], "pre", "given")
    same = F.col("file").eqNullSafe(F.col("_f"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    stop = F.col("pre") + F.col("given")

    def part(c: Column) -> Column:
        start = F.greatest(F.col("pre"), c * length)
        return F.struct(c.alias("chunk"), start.alias("at"), F.slice("_all", (start - F.col("pre") + 1).cast("int"), (F.least(stop, (c + 1) * length) - start).cast("int")).alias("piece"))

    chunks = F.sequence(F.floor(F.col("pre") / length).cast("bigint"), F.floor((stop - 1) / length).cast("bigint"))
    parts = kept.join(spot, same).select("file", F.explode(F.transform(chunks, part)).alias("x")).select("file", "x.*")
    whole = parts.groupBy("file", "chunk").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"])).alias("ids"))
    kept_tail = whole.filter(F.size("ids") >= length // 2)
    return kept_tail.select("file", "chunk", F.concat("ids", F.array_repeat(F.lit(pad), F.lit(length) - F.size("ids"))).alias("tokens"))


def shard_of(chunk_id: Column, chunks_per_shard: int) -> Column:
    return F.floor(chunk_id / chunks_per_shard).cast("bigint")


def first_chunks(chunks: DataFrame, most: int) -> DataFrame:
    if most < 0:
        raise ValueError("a number of chunks can't be below 0")
    return chunks.filter(F.col("chunk_id") < most)
