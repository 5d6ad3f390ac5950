"""Encoding of a whole corpus through a table of distinct words.

Texts are split into pre-tokens inside Spark, once. As they are read, documents
are dealt into blocks of bounded size; a block numbers its distinct words, and
keeps each document as the numbers of its words. What is shuffled are these
numbers and one row for each distinct word of a block, so a word that stands in
every text is at most one row per block. Each distinct word is encoded once;
its ids go back to the blocks that asked for it and are laid out by position
with Arrow gathers.

Results: empty and null texts have the empty list; marker strings are ordinary
text; a repeated row is encoded as often as it stands; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tokens import load_bpe, tokenizer_path
from millrace.llm.words import binary_list, from_binary
from millrace.storage import materialize, spread

#: Words and rows of the documents in one block, about (a longer document is a block of its own).
BLOCK_WORDS, BLOCK_ROWS = 400_000, 5_000

#: The pre-token pattern with White_Space spelled for Java, whose \s is ASCII only (fixed value).
JAVA_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?![^\p{IsWhite_Space}])|\p{IsWhite_Space}+"


def split_words(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the pre-tokens of each text in order; they join up to the text again."""
    pattern = JAVA_PATTERN.replace("\\", "\\\\").replace("'", "\\'")
    return df.select(*keep, F.expr(f"regexp_extract_all(coalesce(`{text}`, ''), '{pattern}', 0)").alias("words"))


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """(word) -> (word, ids), the tokenizer loaded once per worker."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_bpe(path).encode_ordinary
        for batch in it:
            ids = [encode(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    return words.mapInArrow(run, "word string, ids array<int>")


def number_words(split: DataFrame) -> DataFrame:
    """(doc_id, words) -> rows of documents (block, doc_id, codes) and of their blocks' words (block, word, code)."""
    schema = f"block bigint, code int, word string, codes binary, doc_id {split.schema['doc_id'].dataType.simpleString()}"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in it:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_WORDS, "right")) - 1)
                hi = min(hi, lo + BLOCK_ROWS, batch.num_rows)
                at = offsets[lo : hi + 1] - offsets[lo]
                coded = lists.values.slice(offsets[lo], at[-1]).dictionary_encode()
                words, n = coded.dictionary, hi - lo
                codes = binary_list(coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), at)
                yield _row(schema_names, n, block=np.full(n, block), codes=codes, doc_id=batch.column(0).slice(lo, n), ids=batch.column(0).type)
                m = len(words)
                yield _row(schema_names, m, block=np.full(m, block), code=np.arange(m, dtype=np.int32), word=words, ids=batch.column(0).type)
                block += 1
                lo = hi

    schema_names = ("block", "code", "word", "codes", "doc_id")
    return split.select("doc_id", "words").mapInArrow(run, schema)


def _row(names: tuple[str, ...], n: int, ids: pa.DataType, **columns) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "code": pa.int32(), "word": pa.string(), "codes": pa.binary(), "doc_id": ids}
    arrays = [pa.nulls(n, kinds[c]) if columns.get(c) is None else columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], kinds[c]) for c in names]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _lay_out(docs: pa.Table, table: pa.Table) -> pa.Table:
    """Ids of the documents of one block, from the block's table of words."""
    codes, starts = from_binary(docs.column("codes"), np.int32)
    table = table.sort_by("code")  # codes are 0, 1, 2 ...
    ids = table.column("ids").combine_chunks()
    id_starts, id_flat = ids.offsets.to_numpy().astype(np.int64), ids.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(id_starts)[codes] if len(codes) else np.empty(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    out = id_flat[np.repeat(id_starts[:-1][codes] - ends[:-1], lengths) + np.arange(ends[-1])] if len(codes) else np.empty(0, np.int32)
    encoded = pa.ListArray.from_arrays(pa.array(ends[starts].astype(np.int32)), pa.array(out.astype(np.int32)))
    return pa.table({"doc_id": docs.column("doc_id"), "ids": encoded})


def encode_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids) of each row."""
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    numbered = materialize(number_words(split_words(docs, "text", ["doc_id"])), "words")
    asked = numbered.filter(F.col("code").isNotNull()).select(F.col("block").alias("b"), "code", "word")
    encoded = encode_words(asked.select("word").distinct(), path)
    tables = asked.join(encoded.withColumnRenamed("word", "w"), F.col("word") == F.col("w")).select("b", "code", "ids")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def lay_out(left: pa.Table, right: pa.Table) -> pa.Table:
        return _lay_out(left, right)

    rows = numbered.filter(F.col("code").isNull()).select("block", "doc_id", "codes")
    return rows.groupBy("block").cogroup(tables.groupBy("b")).applyInArrow(lay_out, f"doc_id {id_type}, ids array<int>")


def pieces(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, piece in hex) of the vocabulary, 50,256 rows."""
    ranks = load_bpe(path or tokenizer_path("byte_bpe_50k.tiktoken"))._mergeable_ranks
    return spark.createDataFrame([(i, b.hex()) for b, i in ranks.items()], "id int, piece string")


def _lay_out_text(docs: pa.Table, table: pa.Table) -> pa.Table:
    """Texts of the documents of one block, from the block's table of pieces."""
    lists = docs.column("ids").combine_chunks()
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    place = pc.index_in(flat, value_set=table.column("id").combine_chunks())
    pieces = table.column("piece").combine_chunks().take(place) if len(flat) else pa.array([], pa.binary())
    pieces = pc.fill_null(pieces, b"").cast(pa.large_binary())
    at, data = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1), pieces.buffers()[2]
    whole = memoryview(data) if data is not None else memoryview(b"")
    ends = at[starts - starts[0]].tolist()
    texts = [bytes(whole[x:y]).decode("utf-8", "replace") for x, y in zip(ends, ends[1:])]
    return pa.table({"doc_id": docs.column("doc_id"), "text": pa.array(texts, pa.string())})


def decode_corpus(encoded: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, text) by a join of ids with the vocabulary (id, piece in hex), whose size is that of the tokenizer.

    As in encoding, a block of documents asks once for each of its ids. Null
    lists give the empty text, ids outside the vocabulary nothing, and bytes
    that are no UTF-8 the replacement character.
    """
    docs = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids").cast("bigint")), F.lit(0))).first()
    blocks = max(1, -(-size // BLOCK_WORDS), -(-n // BLOCK_ROWS))
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(blocks)).cast("bigint"))
    asked = docs.select(F.col("block").alias("b"), F.explode("ids").alias("i")).distinct()
    tables = asked.join(F.broadcast(vocabulary), F.col("i") == F.col("id")).select("b", "id", F.unhex("piece").alias("piece"))
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def lay_out(left: pa.Table, right: pa.Table) -> pa.Table:
        return _lay_out_text(left, right)

    return docs.groupBy("block").cogroup(tables.groupBy("b")).applyInArrow(lay_out, f"doc_id {id_type}, text string")


def corpus_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 6 over the whole of documents."""
    return encode_corpus(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents, encoded and decoded again."""
    return decode_corpus(materialize(corpus_ids(spark, sf_dir), "ids"), pieces(spark))
