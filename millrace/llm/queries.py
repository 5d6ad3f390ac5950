"""Queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import crosssplit, encoding, leakage, mixing, neardup, packing, pii, tokens

Query = Callable[[SparkSession, str], DataFrame]


def _packed_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and code points in the sequences, by source."""
    packed = packing.pack_upstream(spark, sf_dir)
    return packed.groupBy("repo", "config").agg(F.count_if(F.col("piece") == 0).alias("n_records"), F.sum("length").alias("n_chars"))


def _packed_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every packing must hold, and whether the sequences are within 11/9 of the least number that the code points could fill."""
    packed = packing.pack_upstream(spark, sf_dir)
    before = F.lag(F.col("place") + F.col("length"), 1, 0).over(Window.partitionBy("sequence").orderBy("place"))
    bins = (
        packed.withColumn("gap", F.col("place") - before)
        .groupBy("sequence")
        .agg(F.count(F.lit(1)).alias("pieces"), F.sum("length").alias("chars"), F.max("fill").alias("fill"), F.max(F.abs("gap")).alias("gap"))
    )
    capacity = packing.CAPACITY
    totals = bins.agg(
        F.coalesce(F.sum("pieces"), F.lit(0)).alias("n_pieces"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("n_chars"),
        F.count_if(F.col("chars") > capacity).alias("over_capacity"),
        F.count_if((F.col("chars") != F.col("fill")) | (F.col("gap") != 0)).alias("with_gaps"),
        F.count(F.lit(1)).alias("n"),
    )
    least = F.ceil(F.col("n_chars") / capacity)
    return totals.select("n_pieces", "n_chars", least.cast("bigint").alias("least_sequences"), "over_capacity", "with_gaps", (F.col("n") <= least * 11 / 9 + 1).alias("near_least"))


def _packing_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences, the least number that the code points could fill, and the share of unused room."""
    used = packing.pack_upstream(spark, sf_dir).agg(F.count_distinct("sequence").alias("sequences"), F.coalesce(F.sum("length"), F.lit(0)).alias("chars"))
    room = F.col("sequences") * packing.CAPACITY
    return used.select("sequences", F.ceil(F.col("chars") / packing.CAPACITY).cast("bigint").alias("least"), F.when(room > 0, 1 - F.col("chars") / room).otherwise(0.0).alias("unused"))


def _exact_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of p2_report that hashes alone decide: rows and exact overlaps by split and source."""
    return crosssplit.cross_split(spark, sf_dir).report().select("split", "source_id", "n_rows", "n_exact")


def _target_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source has and is to have, and whether the mixture keeps to four uses and what it takes to what there is."""
    rows = mixing.source_shares(spark, sf_dir)
    kept = (F.col("largest_repeat") <= mixing.MAX_USES) & (F.col("actual_bytes") <= mixing.MAX_USES * F.col("available_bytes"))
    return rows.select("id", "available_bytes", F.round("target_share", 6).alias("target_share"), kept.alias("kept"))


def _slice_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube of p5_slices without tokens."""
    return tokens.token_slices(spark, sf_dir).select("id", "lang", "type", "level", "n_texts", "n_bytes")


QUERIES: dict[str, Query] = {
    "p1_sequences": packing.pack_upstream,
    "p1_packed_size": _packed_size,
    "p1_bins": _packed_bins,
    "p1_waste": _packing_waste,
    "p2_found": lambda s, d: crosssplit.cross_split(s, d).found(),
    "p2_report": lambda s, d: crosssplit.cross_split(s, d).report(),
    "p2_exact": _exact_overlaps,
    "p2_links": lambda s, d: crosssplit.cross_split(s, d).links(),
    "p2_coverage": lambda s, d: crosssplit.cross_split(s, d).coverage(),
    "p3_found": lambda s, d: neardup.near_duplicates(s, d).found(),
    "p3_groups": lambda s, d: neardup.near_duplicates(s, d).groups(),
    "p4_mix": mixing.mixed_records,
    "p4_shares": mixing.source_shares,
    "p4_targets": _target_shares,
    "p5_tokens": tokens.token_counts,
    "p5_slices": tokens.token_slices,
    "p5_sizes": _slice_sizes,
    "p6_ids": encoding.corpus_ids,
    "p6_decoded": encoding.round_trip,
    "p7_found": leakage.leaked_found,
    "p7_tiles": leakage.leaked,
    "p7_items": leakage.leaked_items,
    "p8_found": pii.personal_found,
    "p8_redacted": pii.redacted,
}

_PLAN_ID = "(SELECT repo, revision, config, split, first(id ORDER BY plan_idx) AS id FROM source_plan_2026_10_02 GROUP BY ALL)"
_WITH_ID = f"""SELECT u.text, u.ordinal, p.id FROM upstream_identity_v1 u LEFT JOIN {_PLAN_ID} p ON u.source.repo IS NOT DISTINCT FROM p.repo AND u.source.revision IS NOT DISTINCT FROM p.revision
    AND u.source.config IS NOT DISTINCT FROM p.config AND u.source.split IS NOT DISTINCT FROM p.split"""

SQL: dict[str, str] = {
    "p1_bins": """
        SELECT CAST(sum((length(text) + 2047) // 2048) AS BIGINT) AS n_pieces, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST((sum(length(text)) + 2047) // 2048 AS BIGINT) AS least_sequences,
            0::BIGINT AS over_capacity, 0::BIGINT AS with_gaps, true AS near_least
        FROM upstream_identity_v1 WHERE length(text) > 0""",
    "p2_exact": """
        WITH d AS (SELECT lower(trim(split)) AS split, source_id, regexp_replace(lower(trim(content_hash)), '^sha256:', '') AS hash FROM decisions WHERE split IS NOT NULL AND content_hash IS NOT NULL)
        SELECT split, source_id, count(*) AS n_rows, count(*) FILTER (hash IN (SELECT hash FROM d WHERE split = 'train')) AS n_exact FROM d WHERE split <> 'train' GROUP BY ALL""",
    "p4_targets": f"""
        WITH held AS (SELECT id, sum(n)::BIGINT AS n FROM (SELECT id, ordinal, max(strlen(text)) AS n FROM ({_WITH_ID}) WHERE id IS NOT NULL AND strlen(text) > 0 GROUP BY ALL) GROUP BY id),
          q AS (SELECT id, coalesce(greatest(first(quotas.normal ORDER BY plan_idx), 0), 0) AS q FROM source_plan_2026_10_02 GROUP BY id)
        SELECT q.id, coalesce(n, 0) AS available_bytes, round(q / (SELECT sum(q) FROM q)::DOUBLE, 6) AS target_share, true AS kept FROM q LEFT JOIN held USING (id)""",
    "p5_sizes": f"""
        WITH parsed AS (SELECT source_id, row_ordinal, ok, nullif(lower(trim(regexp_replace(CASE WHEN ok THEN j::JSON ->> '$.lang' END, '[-_].*', ''))), '') AS lang, nullif(lower(trim(CASE WHEN ok THEN j::JSON ->> '$.type' END)), '') AS type
            FROM (SELECT source_id, row_ordinal, predicted_label_json AS j, coalesce(json_valid(predicted_label_json), false) AS ok FROM cpt_labels)),
          best AS (SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY source_id, row_ordinal ORDER BY NOT ok, lang IS NULL, type IS NULL, lang, type) = 1),
          base AS (SELECT coalesce(u.id, '(no plan entry)') AS id, CASE WHEN b.source_id IS NULL THEN '(no label)' ELSE coalesce(b.lang, '(unknown)') END AS lang, CASE WHEN b.source_id IS NULL THEN '(no label)' ELSE coalesce(b.type, '(unknown)') END AS type, coalesce(strlen(text), 0) AS n
            FROM ({_WITH_ID}) u LEFT JOIN best b ON u.id = b.source_id AND u.ordinal = b.row_ordinal)
        SELECT id, lang, type, CAST(grouping(id) * 4 + grouping(lang) * 2 + grouping(type) AS INT) AS level, count(*) AS n_texts, CAST(sum(n) AS BIGINT) AS n_bytes FROM base GROUP BY CUBE (id, lang, type)""",
    "p1_packed_size": """
        SELECT source.repo AS repo, source.config AS config, count(*) AS n_records, CAST(sum(length(text)) AS BIGINT) AS n_chars
        FROM upstream_identity_v1 WHERE length(text) > 0 GROUP BY ALL""",
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
