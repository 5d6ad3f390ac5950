"""Scans: JSON lines, raw sources with ordinals, labels, text files, file listings."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import is_blank, path_matches, strip


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist, in their order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def there(p: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(conf).exists(path)

    return [p for p in paths if there(p)]


def lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, value) of every physical line of the files that exist; gzip by suffix."""
    paths = existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], "file string, value string")
    return spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), "value")


def text_field(value: Column, field: str) -> Column:
    """'ok', 'invalid_json', 'missing_field' or 'empty_text' of a line of JSON."""
    parsed = F.try_parse_json(value)
    member = F.try_variant_get(parsed, f"$.{field}", "variant")
    kind = F.schema_of_variant(member)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    has = F.coalesce(is_object, F.lit(False)) & member.isNotNull()
    content = F.try_variant_get(parsed, f"$.{field}", "string")
    return (
        F.when(parsed.isNull(), "invalid_json")
        .when(~has, "missing_field")
        .when((kind != "STRING") | is_blank(content), "empty_text")
        .otherwise("ok")
    )


def numbered_lines(read: DataFrame, out: str = "number") -> DataFrame:
    """(file, value, ``out``): the non-blank lines of ``spark.read.text(...)``, numbered from 0 in the order of files and lines.

    Files are split as the engine likes; a line's number is that of its split's
    first line and its place in the split. One small row per split is shared.
    """
    block = F.col("_metadata.file_block_start")
    kept = read.select(F.col("_metadata.file_path").alias("file"), block.alias("_block"), "value").filter(~is_blank(F.col("value")))
    rows = kept.withColumn("_id", F.monotonically_increasing_id())
    splits = rows.groupBy(F.col("file").alias("_f"), F.col("_block").alias("_b")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = rows.join(F.broadcast(starts), (F.col("file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return joined.select("file", "value", (F.col("_start") + F.col("_id") - F.col("_first")).alias(out))


def scan_jsonl(spark: SparkSession, paths: Sequence[str], field: str = "text", max_samples: int | None = None) -> DataFrame:
    """(file, status, text) of the non-blank lines; ``text`` only where status is 'ok'.

    Files that don't exist are passed over. A field that is no string counts
    as empty_text, a line that is no object as missing_field. With
    ``max_samples`` above 0 the scan ends with the line that gives so many
    texts.
    """
    status = text_field(strip(F.col("value")), field)
    text = F.try_variant_get(F.try_parse_json(F.col("value")), f"$.{field}", "string")
    shown = ["file", status.alias("status"), F.when(status == "ok", text).alias("text")]
    if not max_samples:
        return lines(spark, paths).filter(~is_blank(F.col("value"))).select(*shown)
    found = existing(spark, paths)
    if not found:
        return spark.createDataFrame([], "file string, status string, text string")
    # files in the order given
    at = {p: i for i, p in enumerate(found)}
    numbered = None
    for p in found:
        part = numbered_lines(spark.read.text(p)).select(F.lit(at[p]).alias("nth"), "number", *shown)
        numbered = part if numbered is None else numbered.unionByName(part)
    last = numbered.filter("status = 'ok'").orderBy("nth", "number").limit(max_samples).agg(F.max(F.struct("nth", "number")).alias("m"), F.count(F.lit(1)).alias("n")).first()
    if last["n"] < max_samples:
        return numbered.select("file", "status", "text")
    nth, number = last["m"]
    return numbered.filter((F.col("nth") < nth) | (F.col("nth") == nth) & (F.col("number") <= number)).select("file", "status", "text")


def jsonl_counters(scanned: DataFrame) -> DataFrame:
    kinds = ("ok", "invalid_json", "missing_field", "empty_text")
    return scanned.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == k).alias("valid" if k == "ok" else k) for k in kinds])


def count_lines(spark: SparkSession, paths: Sequence[str]) -> int:
    """All physical lines of the files that exist, blank ones too."""
    paths = existing(spark, paths)
    return spark.read.text(list(paths)).count() if paths else 0


def read_labels(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Labels from Parquet or JSON lines, by suffix; an empty list is an error."""
    from pyspark.sql.types import _parse_datatype_string

    schema = "source_id string, row_ordinal bigint, doc_id string, document_hash string, input_bytes bigint, input_truncated boolean, predicted_label_json string, predicted_route string"
    if not paths:
        raise ValueError("no label files")
    if all(p.endswith((".jsonl", ".json")) for p in paths):
        return spark.read.schema(_parse_datatype_string(schema)).option("mode", "FAILFAST").json(list(paths))
    return spark.read.parquet(*paths)


def label_files(listing: Sequence[str], revision: str, files: Sequence[str] | None = None, pattern: str | None = None) -> list[str]:
    """The label files of a mirror at a pinned revision: those named, which must be in the listing, or those that fit a pattern, sorted."""
    if not re.fullmatch(r"[0-9a-f]{40}", revision or ""):
        raise ValueError("the revision must be pinned")
    chosen = list(files) if files else sorted(p for p in listing if fnmatch.fnmatchcase(p, pattern or "*"))
    if not chosen:
        raise ValueError("no label files")
    if set(chosen) - set(listing):
        raise ValueError("label files are absent at this revision")
    return chosen


def read_raw_jsonl(spark: SparkSession, path: str, source_id: str, field: str = "text") -> DataFrame:
    """(source_id, ordinal, text) of a local mirror: ordinals count non-blank lines from 0; a line that is no JSON fails the job.

    A field that is no string gives a null text, which no identity check passes.
    """
    member = F.try_variant_get(F.parse_json("value"), f"$.{field}", "variant")
    text = F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(F.parse_json("value"), f"$.{field}", "string"))
    return numbered_lines(spark.read.text(path), "ordinal").select(F.lit(source_id).alias("source_id"), "ordinal", text.alias("text"))


def read_raw_parquet(spark: SparkSession, path: str, source_id: str, field: str = "text") -> DataFrame:
    """(source_id, ordinal, text) of Parquet files, split as the engine likes: ordinal = rows of earlier files + row in the file."""
    read = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.col(field).alias("text"))
    # one row per file of the source
    sizes = read.groupBy("file").agg((F.max("row") + 1).alias("n"))
    starts = sizes.select(F.col("file").alias("f"), F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return read.join(starts, F.col("file") == F.col("f")).select(F.lit(source_id).alias("source_id"), (F.col("start") + F.col("row")).alias("ordinal"), "text")


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(text): stripped non-blank lines."""
    return spark.read.text(path).select(strip(F.col("value")).alias("text")).filter(F.col("text") != "")


def list_files(spark: SparkSession, root: str, pattern: str = "*", fallback: str | None = None) -> DataFrame:
    """(path, size) below ``root`` whose relative path or base name fits; if none does, those that fit ``fallback``. Sorted by path when collected with orderBy."""
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = F.regexp_replace("path", r"\A[a-z]+:/*", "/")
    relative = F.substring(base, F.lit(len(root.rstrip("/")) + 2), F.length(base))
    files = every.select(relative.alias("path"), F.col("length").alias("size"))
    hit = files.filter(path_matches(F.col("path"), pattern))
    if fallback is not None and not hit.limit(1).count():
        hit = files.filter(path_matches(F.col("path"), fallback))
    return hit


def read_scored_jsonl(spark: SparkSession, root: str, score: str, least: float, field: str = "text") -> DataFrame:
    """(file, text) of all JSON-lines files below ``root`` whose score reaches ``least``; unreadable lines are passed over.

    An absent score is 0.0; null or no number is refused; the score is tested before the text.
    """
    from millrace.functions.text import score_at_least

    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl*").text(root)
    v = F.try_parse_json("value")
    member = F.try_variant_get(v, f"$.{score}", "variant")
    rows = read.select(F.col("_metadata.file_path").alias("file"), v.alias("v"), member.isNull().alias("absent"), F.try_variant_get(v, f"$.{score}", "string").alias("score"))
    kept = rows.filter(F.col("v").isNotNull() & score_at_least(F.col("score"), least, F.col("absent")))
    return kept.select("file", F.try_variant_get("v", f"$.{field}", "string").alias("text")).filter(~is_blank(F.col("text")))


def read_ordered_jsonl(spark: SparkSession, root: str, field: str = "text", score: str = "score") -> DataFrame:
    """(key, text, score) of all JSON-lines files below ``root``, with ``key`` in the order of paths and lines.

    Unreadable lines are passed over. An absent score reads as 0.0, one that is
    null as null.
    """
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl*").text(root)
    parsed = F.try_parse_json("value")
    absent = F.try_variant_get(parsed, f"$.{score}", "variant").isNull()
    return (
        numbered_lines(read, "key")
        .filter(parsed.isNotNull())
        .select(
            "key",
            F.try_variant_get(parsed, f"$.{field}", "string").alias("text"),
            F.when(absent, F.lit("0.0")).otherwise(F.try_variant_get(parsed, f"$.{score}", "string")).alias("score"),
        )
    )
