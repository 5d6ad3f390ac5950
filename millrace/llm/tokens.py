"""Token counts per text and their totals by source, language and domain.

The tokenizer is loaded once per worker, texts are encoded in Arrow batches,
and the exact counts are summed over the cube of plan id, language and domain.

Results: null and empty texts have 0 tokens; repeated rows count as often as
they stand; a text whose label is absent lies in the slice '(no label)', one
whose label is unreadable or lacks the field in '(unknown)', one whose source
is not in the plan in '(no plan entry)'; of several labels for one coordinate
the readable one smallest by (lang, type) holds. In the cube a null key stands
for "all".
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.storage import spread

NO_LABEL, UNKNOWN, NO_PLAN = "(no label)", "(unknown)", "(no plan entry)"

#: GPT-2 style pre-token pattern of the byte-level vocabularies (fixed value).
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict[str, object] = {}


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file; the folder is a parameter (MILLRACE_TOKENIZERS)."""
    return os.path.join(os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers"), name)


def load_bpe(path: str):
    """The byte-level BPE of a rank file, loaded once per worker process."""
    if path not in _loaded:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _loaded[path] = tiktoken.Encoding("bpe", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def count_tokens(df: DataFrame, text: str, keep: list[str], path: str | None = None) -> DataFrame:
    """``keep`` columns and n_tokens of each row's text, without special tokens."""
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")
    narrow = df.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1]] + ["n_tokens bigint"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one batch at a time on the task's own core
        encode = load_bpe(path).encode_ordinary_batch
        for batch in it:
            texts = pc.fill_null(batch.column(batch.num_columns - 1), "").to_pylist()
            counts = pa.array(list(map(len, encode(texts, num_threads=1))), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], names=[*batch.schema.names[:-1], "n_tokens"])

    return narrow.mapInArrow(run, schema)


def plan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan's coordinates and ids: 40 rows at every scale (TESTDATA.md), so it may be broadcast."""
    return spark.read.parquet(f"{sf_dir}/source_plan_2026_10_02.parquet").groupBy("repo", "revision", "config", "split").agg(F.min_by("id", "plan_idx").alias("id"))


def with_plan_id(upstream: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``id``; null where the source has no plan entry."""
    same = [F.col(f"u.source.{k}").eqNullSafe(F.col(f"p.{k}")) for k in ("repo", "revision", "config", "split")]
    return upstream.alias("u").join(F.broadcast(plan.alias("p")), same[0] & same[1] & same[2] & same[3], "left").select("u.*", F.col("p.id").alias("id"))


def label_fields(labels: DataFrame) -> DataFrame:
    """One row per label coordinate: lang, type and quality as read."""

    def tidy(c: Column) -> Column:
        return F.nullif(F.lower(F.trim(c)), F.lit(""))

    parsed = labels.select(
        "source_id",
        "row_ordinal",
        F.from_json("predicted_label_json", "type string, lang string, q struct<utility: double, fluency: double, noise: double>", {"mode": "PERMISSIVE"}).alias("j"),
        F.expr("try_parse_json(predicted_label_json) IS NOT NULL").alias("readable"),
    ).select(
        "source_id",
        "row_ordinal",
        "readable",
        F.when(F.col("readable"), tidy(F.regexp_replace(F.col("j.lang"), "[-_].*", ""))).alias("lang"),
        F.when(F.col("readable"), tidy(F.col("j.type"))).alias("type"),
        F.when(F.col("readable"), F.col("j.q")).alias("q"),
    )
    best = F.struct(~F.col("readable"), F.col("lang").isNull(), F.col("type").isNull(), "lang", "type", F.col("q.utility").alias("utility"), F.col("q.fluency").alias("fluency"), F.col("q.noise").alias("noise"))
    return parsed.groupBy("source_id", "row_ordinal").agg(F.min(best).alias("b")).select("source_id", "row_ordinal", "b.lang", "b.type", "b.utility", "b.fluency", "b.noise", F.lit(True).alias("labelled"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem 5: each row of upstream_identity_v1 with its slice and number of tokens."""
    upstream = spread(spark.read.parquet(f"{sf_dir}/upstream_identity_v1.parquet").select("source", "ordinal", "text"))
    known = with_plan_id(upstream, plan_ids(spark, sf_dir)).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    counted = count_tokens(known, "text", ["id", "ordinal", "n_bytes"])
    labels = label_fields(spark.read.parquet(f"{sf_dir}/cpt_labels.parquet"))
    joined = counted.join(labels, (F.col("id") == F.col("source_id")) & (F.col("ordinal") == F.col("row_ordinal")), "left")

    def slice_of(field: str) -> Column:
        return F.when(F.col("labelled").isNull(), F.lit(NO_LABEL)).otherwise(F.coalesce(F.col(field), F.lit(UNKNOWN)))

    return joined.select(F.coalesce("id", F.lit(NO_PLAN)).alias("id"), "ordinal", slice_of("lang").alias("lang"), slice_of("type").alias("type"), "n_bytes", "n_tokens")


def token_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the cube of (id, lang, type); summed once before the cube expands them."""
    base = token_counts(spark, sf_dir).groupBy("id", "lang", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b"), F.sum("n_tokens").alias("t"))
    return base.cube("id", "lang", "type").agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n_texts"), F.sum("b").alias("n_bytes"), F.sum("t").alias("n_tokens"))
