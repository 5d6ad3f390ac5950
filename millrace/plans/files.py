"""Queries of sources and sinks: tables are written below the shared folder and read again, and SQL says what must come back.

Each is registered like the queries of millrace.plans.registry, over its whole
tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import identity, text
from millrace.operators import mixing, packing, partition, tokenize
from millrace.plans import pipeline
from millrace.plans.registry import FRACTION, LENGTH, PLAN, SEED, SQL, T, WS, _decided, _mixed, _packed, _sql_mix, _sql_pack, _sql_split, _streams, query, table, texts
from millrace.sources import cache, readers, sinks
from millrace.storage import materialize, shared_dir


def _folder(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


def _as_lines(s: SparkSession, d: str, name: str, more: str = "", packed: bool = False) -> str:
    """The documents as JSON lines; null texts lack the field, and ``more`` is a line for each document without a text."""
    path = _folder(s, name)
    docs = table(s, d, "documents")
    line = F.to_json(F.struct("doc_id", "text"))
    lines = docs.select(line.alias("value"))
    if more:
        lines = lines.unionByName(docs.filter("text IS NULL").select(F.lit(more).alias("value")))
    lines.write.option("compression", "gzip" if packed else "none").text(path)
    return path


_STATES = f"""SELECT count(*) AS total, count(*) FILTER (text IS NOT NULL AND NOT regexp_matches(text, '\\A{WS}*\\z')) AS valid, count(*) FILTER (text IS NULL) AS missing_field,
    count(*) FILTER (text IS NOT NULL AND regexp_matches(text, '\\A{WS}*\\z')) AS empty_text FROM documents"""


@query("jsonl_counters", f"SELECT total + missing_field AS total, valid, missing_field AS invalid_json, missing_field, empty_text FROM ({_STATES})")
def _(s, d):
    """Documents as JSON lines, with a broken line for each that has no text."""
    return readers.jsonl_counters(readers.scan_jsonl(s, [_as_lines(s, d, "jsonl", "{broken")]))


@query("jsonl_gzip_texts", f"SELECT text FROM {T} WHERE NOT regexp_matches(text, '\\A{WS}*\\z')")
def _(s, d):
    return readers.scan_jsonl(s, [_as_lines(s, d, "packed", packed=True)]).filter("status = 'ok'").select("text")


@query("line_count", "SELECT count(*) + count(*) FILTER (text IS NULL) AS n FROM documents")
def _(s, d):
    """All lines, blank ones too."""
    return s.createDataFrame([(readers.count_lines(s, [_as_lines(s, d, "lines", " ")]),)], "n bigint")


@query("label_scan", "SELECT source_id, row_ordinal, document_hash, input_bytes, input_truncated, predicted_route FROM cpt_labels")
def _(s, d):
    """Labels written as JSON lines and read with their schema."""
    path = _folder(s, "labels") + ".jsonl"
    rows = table(s, d, "cpt_labels")
    rows.write.option("ignoreNullFields", "false").json(path)
    return readers.read_labels(s, [path]).select("source_id", "row_ordinal", "document_hash", "input_bytes", "input_truncated", "predicted_route")


@query("raw_mirror", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, text FROM documents WHERE text IS NOT NULL")
def _(s, d):
    """A mirror of one sorted table: ordinals are the places of its rows."""
    path = _folder(s, "mirror")
    texts(s, d).select("doc_id", "text").orderBy("doc_id").coalesce(1).write.json(path)
    return readers.read_raw_jsonl(s, path, "documents").select("ordinal", "text")


@query("raw_parquet", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, text FROM documents")
def _(s, d):
    path = _folder(s, "raw")
    table(s, d, "documents").select("doc_id", "text").orderBy("doc_id").write.parquet(path)
    return readers.read_raw_parquet(s, path, "documents").select("ordinal", "text")


@query("scored_scan", f"SELECT text FROM {T} WHERE score >= 2.5 AND NOT isnan(score) AND NOT regexp_matches(text, '\\A{WS}*\\z')")
def _(s, d):
    """Texts whose score, read from JSON, reaches the bound."""
    path = _as_scored(s, d)
    return readers.read_scored_jsonl(s, path, "score", 2.5).select("text")


def _as_scored(s: SparkSession, d: str) -> str:
    """Documents with scores as files of JSON lines; absent scores lack the field, NaN is no number of JSON."""
    path = _folder(s, "scored")
    docs = table(s, d, "documents").select("text", F.when(~F.isnan("score"), F.col("score")).alias("score"))
    docs.write.option("compression", "none").json(path)
    jvm = s.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.endswith(".json"):
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(root, f"{name}l"))
    return path


@query("text_lines", f"SELECT regexp_replace(regexp_replace(l, '\\A{WS}+', ''), '{WS}+\\z', '') AS text FROM (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS l FROM {T}) WHERE NOT regexp_matches(l, '\\A{WS}*\\z')")
def _(s, d):
    """Every text written as lines of plain text."""
    path = _folder(s, "plain")
    texts(s, d).select("text").write.text(path)
    return readers.read_text_lines(s, path)


def _cache(s: SparkSession, d: str) -> str:
    path = _folder(s, "cache")
    cache.write_cache(_packed(s, d), path, {"split": "train"}, LENGTH, 100)
    return path


_CHUNKS = f"""WITH {_sql_pack(T, 'doc_id')}, tok AS (SELECT pre, unnest(list_append(list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)), 2)) AS t,
    generate_subscripts(list_append(list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)), 2), 1) - 1 AS j FROM giv WHERE given > 0)
  SELECT m.chunk_id, m.valid_length, m.source, md5(string_agg(t, ',' ORDER BY pre + j)) AS ids FROM tok JOIN major m ON (pre + j) // {LENGTH} = m.chunk_id GROUP BY ALL"""


def _valid(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_id", "valid_length", "source", F.md5(F.array_join(F.slice("tokens", F.lit(1), F.col("valid_length").cast("int")), ",")).alias("ids"))


@query("cache_round_trip", _CHUNKS)
def _(s, d):
    """Packed chunks written as a cache, validated and read again."""
    return _valid(cache.read_cache(s, _cache(s, d)))


@query("flat_round_trip", _CHUNKS)
def _(s, d):
    """The cache as flat arrays, and back."""
    out = _folder(s, "flat")
    cache.export_flat(s, _cache(s, d), out, "uint32")
    return _valid(cache.read_flat(s, out))


@query("cache_manifest", f"WITH {_sql_pack(T, 'doc_id')} SELECT c.src AS source, sum(c.m)::BIGINT AS n_tokens, coalesce(any_value(k.n), 0) AS n_chunks FROM cut c LEFT JOIN (SELECT source, count(*) AS n FROM major GROUP BY ALL) k ON c.src = k.source GROUP BY c.src")
def _(s, d):
    """Counts by source in the manifest."""
    m = cache.read_json(s, f"{_cache(s, d)}/manifest.json")
    return s.createDataFrame([(n, t, m["source_chunk_counts"].get(n, 0)) for n, t in m["source_token_counts"].items()], "source string, n_tokens bigint, n_chunks bigint")


@query("first_chunks", f"WITH {_sql_pack(T, 'doc_id')} SELECT chunk_id, source FROM major WHERE chunk_id < 5")
def _(s, d):
    return packing.first_chunks(_packed(s, d), 5).select("chunk_id", "source")


@query("rolled_jsonl", f"SELECT doc_id, CAST(coalesce(sum(strlen(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 100000 AS BIGINT) AS shard, text FROM {T}")
def _(s, d):
    """Documents in shards of about 100,000 bytes, read again."""
    path = _folder(s, "rolled")
    sinks.write_rolled_jsonl(texts(s, d).select("doc_id", "text"), path, ["doc_id"], 100_000)
    return s.read.schema("doc_id bigint, text string, shard bigint").json(path)


def _owners(s: SparkSession, d: str) -> DataFrame:
    return materialize(_decided(s, d), "decided")


@query("audit_manifest", SQL["audit_rollup"])
def _(s, d):
    """Counts of the audit's manifest; the same as audit_rollup."""
    path = _folder(s, "audit")
    manifest = sinks.write_audit(_owners(s, d), path, "policy")
    return s.createDataFrame([(r["route"], r["decision"], r["split"], r["n"]) for r in manifest["decisions"]], "route string, decision string, split string, n bigint")


@query("secondary_holdout", f"SELECT doc_id AS key FROM {T} WHERE NOT regexp_matches(text, '\\A{WS}*\\z') AND score >= 2.5 AND NOT isnan(score) AND {_sql_split('sha256(text)')} = 'train'")
def _(s, d):
    """A secondary source: score, blank texts and the holdout by hash."""
    rows = texts(s, d).select(F.col("doc_id").alias("key"), "text", F.col("score").cast("string").alias("score"))
    return pipeline.secondary_texts(pipeline.Secondary("documents", rows, score_gte=2.5), pipeline.Rules(fraction=FRACTION, seed=SEED)).select("key")


@query(
    "secondary_counters",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (low) AS low_score, count(*) FILTER (NOT low AND blank) AS blank, count(*) FILTER (NOT low AND NOT blank AND held) AS other_split,
      count(*) FILTER (NOT low AND NOT blank AND NOT held) AS accepted, CAST(coalesce(sum(strlen(text)) FILTER (NOT low AND NOT blank AND NOT held), 0) AS BIGINT) AS accepted_bytes
    FROM (SELECT text, NOT coalesce(score >= 2.5 AND NOT isnan(score), false) AS low, regexp_matches(text, '\\A{WS}*\\z') AS blank, {_sql_split('sha256(text)')} <> 'train' AS held FROM {T})""",
)
def _(s, d):
    rows = texts(s, d).select(F.col("doc_id").alias("key"), "text", F.col("score").cast("string").alias("score"))
    counted = pipeline.secondary_counters(pipeline.Secondary("documents", rows, score_gte=2.5), pipeline.Rules(fraction=FRACTION, seed=SEED))
    return counted.select("n_rows", "low_score", "blank", "other_split", "accepted", "accepted_bytes")


@query("plan_repeats", f"SELECT repo, count(*) AS n FROM {PLAN} GROUP BY repo HAVING count(*) > 1")
def _(s, d):
    """Repositories that several plan entries share; ids must not repeat, which require_plan tests."""
    return table(s, d, PLAN).groupBy("repo").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("pinned_revisions", f"SELECT id, coalesce(regexp_full_match(revision, '[0-9a-f]{{40}}'), false) AS pinned FROM {PLAN}")
def _(s, d):
    return table(s, d, PLAN).select("id", identity.is_revision(F.col("revision")).alias("pinned"))


@query("glob_match", f"SELECT id, coalesce(repo GLOB '*/*-[a-m]*' OR list_last(string_split(repo, '/')) GLOB '*/*-[a-m]*', false) AS hit FROM {PLAN}")
def _(s, d):
    return table(s, d, PLAN).select("id", F.coalesce(text.path_matches(F.col("repo"), "*/*-[a-m]*"), F.lit(False)).alias("hit"))


@query("file_selection", f"SELECT id FROM (SELECT id, row_number() OVER (ORDER BY id) AS k, count(*) OVER () AS n FROM {PLAN}) WHERE k <= greatest(1, round(0.3 * n))")
def _(s, d):
    """The first 30 % of the files of a sorted list."""
    ids = [r["id"] for r in table(s, d, PLAN).select("id").orderBy("id").collect()]  # one row per source
    return s.createDataFrame([(i,) for i in partition.first_share(ids, 0.3, len(ids))], "id string")


@query("size_units", f"SELECT id, CAST(plan_idx * 0.125 * 1073741824 AS BIGINT) AS n_bytes, CAST(floor(plan_idx * 0.125 * 1073741824 / 4.0) AS BIGINT) AS n_tokens FROM {PLAN}")
def _(s, d):
    """Bytes and estimated tokens of so many eighths of a GiB."""
    rows = table(s, d, PLAN).select("id", "plan_idx").collect()  # one row per source
    return s.createDataFrame([(r["id"], text.gigabytes(r["plan_idx"] * 0.125), text.estimated_tokens(r["plan_idx"] * 0.125)) for r in rows], "id string, n_bytes bigint, n_tokens bigint")


@query(
    "vocabulary_check",
    """WITH base AS (SELECT lang AS token, row_number() OVER (ORDER BY lang) - 1 AS id FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
      ext AS (SELECT token, CASE WHEN id = 0 THEN 1000 ELSE id END AS id FROM base UNION ALL SELECT '<new>', (SELECT count(*) FROM base)),
      counts AS (SELECT (SELECT count(*) FROM base) AS b, (SELECT count(*) FROM ext) AS e)
    SELECT token, id, 'lost_or_moved' AS violation FROM base WHERE (token, id) NOT IN (SELECT (token, id) FROM ext)
    UNION ALL SELECT token, id, 'outside_block' FROM ext, counts WHERE token NOT IN (SELECT token FROM base) AND (id < b OR id >= e)""",
)
def _(s, d):
    """A vocabulary of languages, and one that moves its first id and appends a token."""
    langs = [r["lang"] for r in table(s, d, "documents").filter("lang IS NOT NULL").select("lang").distinct().orderBy("lang").collect()]  # as many as there are languages
    base = s.createDataFrame([(t, i) for i, t in enumerate(langs)], "token string, id bigint")
    extended = s.createDataFrame([(t, i or 1000) for i, t in enumerate(langs)] + [("<new>", len(langs))], "token string, id bigint")
    return tokenize.appended_only(base, extended)


@query("observed_ratio", f"WITH {_sql_mix(T)} SELECT count(*) AS n_rows, coalesce(avg((stream = 0)::INT::DOUBLE), 0) AS ratio FROM mixed")
def _(s, d):
    return mixing.observed_ratio(_mixed(_streams(s, d)), F.col("stream") == 0)


@query("phase_sources", f"SELECT id AS dataset, repo FROM {PLAN} WHERE plan_idx % 4 = 0")
def _(s, d):
    """The sources of a phase with their catalog entries."""
    rows = table(s, d, PLAN).select("id", "repo", "plan_idx").collect()  # one row per source
    catalog = {r["id"]: {"repo": r["repo"]} for r in rows}
    made = sinks.phase_manifest({"id": 1, "sources": [{"dataset": r["id"]} for r in rows if r["plan_idx"] % 4 == 0]}, {}, catalog)
    return s.createDataFrame([(x["dataset"], x["catalog"]["repo"]) for x in made["sources"]], "dataset string, repo string")
