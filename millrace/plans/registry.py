"""Queries of the corpus-preparation operators, each with its SQL where SQL can express it.

Every query runs over its whole tables. A document without text is not part of
a stream of texts. Where an operator passes over a stream several times, what it
needs of each text (its length or hash) is taken once and kept.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import identity, text
from millrace.operators import labels, metrics, mixing, order, packing, partition
from millrace.storage import materialize, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LENGTH, SEED, FRACTION = packing.LENGTH, 42, 0.01
MIX = {"tr": 0.8, "en": 0.2}
BYTE_BUDGET, TOKEN_BUDGET = 500_000, 400_000
PLAN = "source_plan_2026_10_02"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(F.col("text").isNotNull())


def dealt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for work on every character: a small table of few files is dealt out over the cores."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).filter(F.col("text").isNotNull())


T = "(SELECT * FROM documents WHERE text IS NOT NULL)"
WS, WS_INLINE = text.WS, text.WS_INLINE


def _sql_rstrip(c: str) -> str:
    return f"regexp_replace({c}, '{WS}+\\z', '')"


def _sql_strip(c: str) -> str:
    return f"regexp_replace({_sql_rstrip(c)}, '\\A{WS}+', '')"


def _sql_clean(c: str) -> str:
    return f"regexp_replace(regexp_replace({_sql_strip(c)}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '{WS_INLINE}+', ' ', 'g')"


def _sql_marker(c: str) -> str:
    bare, n = _sql_rstrip(c), len(text.END_MARKER)
    return f"CASE WHEN ends_with({bare}, '{text.END_MARKER}') THEN {_sql_rstrip(f'left({bare}, length({bare}) - {n})')} ELSE {bare} END"


def _sql_split(h: str) -> str:
    return f"CASE WHEN sha256('{SEED}:' || {h}) < '{identity.split_bound(FRACTION)}' THEN 'validation' ELSE 'train' END"


# Text


@query("clean_text", f"SELECT doc_id, {_sql_clean('text')} AS clean FROM {T}")
def _(s, d):
    return dealt_texts(s, d).select("doc_id", text.clean_text(F.col("text")).alias("clean"))


@query("strip_end_marker", f"SELECT doc_id, {_sql_marker('text')} AS stripped FROM {T}")
def _(s, d):
    return dealt_texts(s, d).select("doc_id", text.strip_end_marker(F.col("text")).alias("stripped"))


def _preprocessed(s: SparkSession, d: str) -> DataFrame:
    clean = text.clean_text(text.strip_end_marker(F.col("text")))
    return dealt_texts(s, d).select("doc_id", (F.length("text") > 1_000_000).alias("huge"), text.n_chars(clean).alias("n_clean"))


_SQL_PRE = f"(SELECT doc_id, length(text) > 1000000 AS huge, CAST(length({_sql_clean(_sql_marker('text'))}) AS BIGINT) AS n_clean FROM {T})"


@query("length_filter", f"SELECT doc_id, n_clean FROM {_SQL_PRE} WHERE NOT huge AND n_clean >= 50")
def _(s, d):
    return _preprocessed(s, d).filter(~F.col("huge") & (F.col("n_clean") >= 50)).select("doc_id", "n_clean")


@query(
    "preprocess_counters",
    f"SELECT count(*) AS total, count(*) FILTER (huge) AS huge, count(*) FILTER (NOT huge AND n_clean < 50) AS too_short, count(*) FILTER (NOT huge AND n_clean >= 50) AS kept FROM {_SQL_PRE}",
)
def _(s, d):
    short, huge = F.col("n_clean") < 50, F.col("huge")
    return _preprocessed(s, d).agg(F.count(F.lit(1)).alias("total"), F.count_if(huge).alias("huge"), F.count_if(~huge & short).alias("too_short"), F.count_if(~huge & ~short).alias("kept"))


@query("text_sizes", f"SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(strlen(text) AS BIGINT) AS n_bytes, regexp_matches(text, '\\A{WS}*\\z') AS blank FROM {T}")
def _(s, d):
    return texts(s, d).select("doc_id", text.n_chars(F.col("text")).alias("n_chars"), text.n_bytes(F.col("text")).alias("n_bytes"), text.is_blank(F.col("text")).alias("blank"))


@query("score_filter", "SELECT doc_id, score FROM documents WHERE score >= 2.5 AND NOT isnan(score)")
def _(s, d):
    return table(s, d, "documents").filter(text.score_at_least(F.col("score"), 2.5)).select("doc_id", "score")


@query(
    "chat_template",
    "SELECT id, '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || expected || '<|im_end|>' || chr(10) AS rendered FROM contract_cases_v1",
)
def _(s, d):
    return table(s, d, "contract_cases_v1").select("id", F.concat(text.chat_turn(F.lit("user"), F.col("prompt")), text.chat_turn(F.lit("assistant"), F.col("expected"))).alias("rendered"))


# Identity and splits


@query("document_hash", f"SELECT doc_id, sha256(text) AS content_hash FROM {T}")
def _(s, d):
    return texts(s, d).select("doc_id", identity.document_hash(F.col("text")).alias("content_hash"))


_SQL_DOCUMENT_ID = "'doc_' || sha256('[' || to_json({0}repo)::VARCHAR || ',' || to_json({0}revision)::VARCHAR || ',' || to_json({0}config)::VARCHAR || ',' || to_json({0}split)::VARCHAR || ',' || ordinal || ',\"' || sha256(text) || '\"]')"


@query("document_id", f"SELECT source.repo AS repo, source.config AS config, ordinal, {_SQL_DOCUMENT_ID.format('source.')} AS document_id FROM upstream_identity_v1")
def _(s, d):
    c = [F.col(f"source.{x}") for x in ("repo", "revision", "config", "split")]
    return table(s, d, "upstream_identity_v1").select(c[0].alias("repo"), c[2].alias("config"), "ordinal", identity.document_id(*c, F.col("ordinal"), F.col("text")).alias("document_id"))


def _split(c: Column) -> Column:
    return identity.content_split(c, FRACTION, SEED)


@query("holdout_split", f"SELECT doc_id, {_sql_split('sha256(text)')} AS split FROM {T}")
def _(s, d):
    return texts(s, d).select("doc_id", _split(identity.document_hash(F.col("text"))).alias("split"))


@query("split_counts", f"SELECT source, {_sql_split('sha256(text)')} AS split, count(*) AS n FROM {T} GROUP BY ALL")
def _(s, d):
    return texts(s, d).groupBy("source", _split(identity.document_hash(F.col("text"))).alias("split")).agg(F.count(F.lit(1)).alias("n"))


def _hashed(s: SparkSession, d: str) -> DataFrame:
    return materialize(texts(s, d).select("doc_id", "source", identity.document_hash(F.col("text")).alias("content_hash")), "hashed")


@query("exact_dedup", f"SELECT doc_id, sha256(text) AS content_hash, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS is_first FROM {T}")
def _(s, d):
    return labels.first_copies(_hashed(s, d), "content_hash", ["doc_id"], F.lit(True)).select("doc_id", "content_hash", "is_first")


@query(
    "dedup_rate_by_source",
    f"SELECT source, count(*) AS n, count(*) FILTER (is_first) AS kept FROM (SELECT source, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS is_first FROM {T}) GROUP BY source",
)
def _(s, d):
    marked = labels.first_copies(_hashed(s, d), "content_hash", ["doc_id"], F.lit(True))
    return marked.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_first").alias("kept"))


@query("split_leaks", f"SELECT h AS content_hash, count(*) AS n FROM (SELECT sha256(text) AS h, {_sql_split('sha256(text)')} AS split FROM {T}) GROUP BY h HAVING count(DISTINCT split) > 1")
def _(s, d):
    """The law of the split: no content stands in two splits (always empty)."""
    rows = _hashed(s, d).withColumn("split", _split(F.col("content_hash")))
    return rows.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n"), F.min("split").alias("a"), F.max("split").alias("b")).filter("a <> b").select("content_hash", "n")


# Labels


def _raw(s: SparkSession, d: str) -> DataFrame:
    return labels.raw_rows(table(s, d, "upstream_identity_v1"), table(s, d, PLAN))


_RAW = f"""raw AS (SELECT DISTINCT p.id AS source_id, p.plan_idx, u.ordinal, u.source.repo AS repo, u.source.revision AS revision, u.source.config AS config, u.source.split AS split, u.text
    FROM upstream_identity_v1 u JOIN {PLAN} p ON u.source.repo = p.repo AND u.source.revision = p.revision AND u.source.config = p.config AND u.source.split = p.split)"""
_LABELS = "lab AS (SELECT DISTINCT * FROM cpt_labels)"
_JOINED = f"""{_RAW}, {_LABELS}, checked AS (
    SELECT r.source_id, r.plan_idx, r.ordinal, l.input_truncated, l.predicted_route, sha256(r.text) AS content_hash,
        coalesce(r.text <> '', false) AS text_ok,
        coalesce(sha256(r.text) = l.document_hash, false) AS hash_ok,
        coalesce({_SQL_DOCUMENT_ID.format('r.')} = l.doc_id, false) AS id_ok,
        coalesce(strlen(r.text) = l.input_bytes, false) AS bytes_ok
    FROM raw r JOIN lab l ON r.source_id = l.source_id AND r.ordinal = l.row_ordinal),
  joined AS (SELECT *, CASE WHEN NOT text_ok THEN 'text' WHEN NOT hash_ok THEN 'hash' WHEN NOT id_ok THEN 'doc_id' WHEN NOT bytes_ok THEN 'bytes' END AS violation FROM checked)"""


def _joined(s: SparkSession, d: str) -> DataFrame:
    return labels.join_labels(_raw(s, d), table(s, d, "cpt_labels").distinct())


@query("label_join", f"WITH {_JOINED} SELECT source_id, ordinal, predicted_route, text_ok, hash_ok, id_ok, bytes_ok, violation FROM joined")
def _(s, d):
    return _joined(s, d).select("source_id", "ordinal", "predicted_route", "text_ok", "hash_ok", "id_ok", "bytes_ok", "violation")


@query("identity_violations", f"WITH {_JOINED} SELECT source_id, violation, count(*) AS n FROM joined WHERE violation IS NOT NULL GROUP BY ALL")
def _(s, d):
    return _joined(s, d).filter(F.col("violation").isNotNull()).groupBy("source_id", "violation").agg(F.count(F.lit(1)).alias("n"))


@query(
    "label_violations",
    f"""SELECT coalesce(v, 'ok') AS violation, count(*) AS n FROM (SELECT CASE
        WHEN source_id IS NULL OR source_id NOT IN (SELECT id FROM {PLAN}) THEN 'unknown_source'
        WHEN row_ordinal IS NULL OR row_ordinal < 0 THEN 'bad_ordinal'
        WHEN predicted_route IS NULL OR predicted_route NOT IN ('PREMIUM', 'KEEP', 'REVIEW', 'DETERMINISTIC_REPAIR', 'MODEL_REPAIR', 'DROP') THEN 'unknown_route'
        WHEN doc_id IS NULL OR document_hash IS NULL THEN 'missing_identity'
        WHEN input_truncated IS NULL THEN 'bad_truncated'
        WHEN input_bytes IS NULL OR input_bytes < 0 THEN 'bad_bytes'
        WHEN NOT coalesce(json_type(CASE WHEN json_valid(predicted_label_json) THEN predicted_label_json END) = 'OBJECT', false) THEN 'bad_label' END AS v FROM cpt_labels) GROUP BY ALL""",
)
def _(s, d):
    ids = [r["id"] for r in table(s, d, PLAN).select("id").distinct().collect()]  # one row per source
    checked = labels.validate_labels(table(s, d, "cpt_labels"), ids)
    return checked.groupBy(F.coalesce("violation", F.lit("ok")).alias("violation")).agg(F.count(F.lit(1)).alias("n"))


@query("repeated_labels", "SELECT source_id, row_ordinal, count(*) AS n FROM cpt_labels GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return labels.repeated_coordinates(table(s, d, "cpt_labels"))


@query("missing_rows", f"WITH {_RAW} SELECT DISTINCT source_id, row_ordinal FROM cpt_labels l WHERE NOT EXISTS (SELECT 1 FROM raw r WHERE r.source_id = l.source_id AND r.ordinal = l.row_ordinal)")
def _(s, d):
    return labels.missing_rows(labels.raw_keys(table(s, d, "upstream_identity_v1"), table(s, d, PLAN)), table(s, d, "cpt_labels")).select("source_id", "row_ordinal").distinct()


@query("unlabelled_rows", f"WITH {_RAW} SELECT source_id, count(*) AS n FROM raw r WHERE NOT EXISTS (SELECT 1 FROM cpt_labels l WHERE r.source_id = l.source_id AND r.ordinal = l.row_ordinal) GROUP BY ALL")
def _(s, d):
    return labels.unlabelled_rows(_raw(s, d), table(s, d, "cpt_labels")).groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))


@query("unknown_sources", f"SELECT source_id, count(*) AS n FROM cpt_labels WHERE source_id IS NULL OR source_id NOT IN (SELECT id FROM {PLAN}) GROUP BY ALL")
def _(s, d):
    ids = table(s, d, PLAN).select("id").distinct()
    return table(s, d, "cpt_labels").join(F.broadcast(ids), F.col("source_id") == F.col("id"), "left_anti").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))


_GATED = ("gokada",)
_DECIDED = f"""{_JOINED}, once AS (SELECT *, count(*) OVER (PARTITION BY source_id, ordinal) AS c FROM joined),
  turn AS (SELECT *, row_number() OVER (PARTITION BY plan_idx ORDER BY ordinal) AS k FROM once WHERE c = 1 AND violation IS NULL),
  placed AS (SELECT *, row_number() OVER (ORDER BY k, plan_idx) - 1 AS pos,
      coalesce(predicted_route IN ('PREMIUM', 'KEEP'), false) AS good, source_id IN ('gokada') AS held, coalesce(input_truncated, false) AS cut FROM turn),
  winners AS (SELECT content_hash, min(pos) AS w FROM placed WHERE good AND NOT held AND NOT cut GROUP BY ALL),
  decided AS (SELECT p.source_id, p.ordinal, p.pos, p.predicted_route AS route, {_sql_split('p.content_hash')} AS split, p.content_hash,
      CASE WHEN NOT good THEN 'excluded_route' WHEN held THEN 'review_gate' WHEN cut THEN 'truncated_input_review' WHEN pos = w THEN 'accepted' ELSE 'duplicate' END AS decision
    FROM placed p LEFT JOIN winners USING (content_hash)
    UNION ALL SELECT source_id, ordinal, NULL, predicted_route, NULL, content_hash, CASE WHEN c > 1 THEN 'repeated_label' ELSE 'violates_' || violation END FROM once WHERE c > 1 OR violation IS NOT NULL)"""


def _decided(s: SparkSession, d: str) -> DataFrame:
    """Decisions over all labelled rows. Those that pass the identity check and have one label compete, sources in turn; the others have no place and say why."""
    joined = materialize(_joined(s, d).select("source_id", "plan_idx", "ordinal", "content_hash", "predicted_route", "input_truncated", "violation"), "joined")
    again = joined.groupBy("source_id", "ordinal").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("source_id").alias("s2"), F.col("ordinal").alias("o2"))
    marked = joined.join(again, (F.col("source_id") == F.col("s2")) & (F.col("ordinal") == F.col("o2")), "left")
    fault = F.when(F.col("s2").isNotNull(), F.lit("repeated_label")).when(F.col("violation").isNotNull(), F.concat(F.lit("violates_"), F.col("violation")))
    told = materialize(marked.select(*joined.columns, fault.alias("fault")), "told")
    in_turn = order.round_robin(told.filter("fault IS NULL"), "plan_idx", ["ordinal"])
    decided = labels.decide(in_turn, ["pos"], gated=_GATED, fraction=FRACTION, seed=SEED)
    refused = told.filter("fault IS NOT NULL").select("*", F.lit(None).cast("bigint").alias("pos"), F.col("fault").alias("decision"), F.lit(None).cast("string").alias("split"))
    return decided.unionByName(refused)


@query("route_decisions", f"WITH {_DECIDED} SELECT source_id, ordinal, pos, route, decision, split FROM decided")
def _(s, d):
    return _decided(s, d).select("source_id", "ordinal", "pos", F.col("predicted_route").alias("route"), "decision", "split")


@query("audit_rollup", f"WITH {_DECIDED} SELECT route, decision, split, count(*) AS n FROM decided GROUP BY ALL")
def _(s, d):
    return labels.audit(_decided(s, d))


@query("accepted_owners", f"WITH {_DECIDED} SELECT content_hash AS hash, source_id, ordinal FROM decided WHERE decision = 'accepted'")
def _(s, d):
    return labels.seen_index(_decided(s, d))


@query(
    "label_profile",
    """WITH typed AS (SELECT source_id, coalesce(lower(trim(CASE WHEN json_valid(predicted_label_json) THEN predicted_label_json::JSON ->> '$.type' END)), '') AS t FROM cpt_labels)
    SELECT source_id, count(*) AS sampled_rows, count(*) FILTER (input_truncated) AS truncated, count(*) FILTER (e) AS eligible, CAST(coalesce(sum(input_bytes) FILTER (e), 0) AS BIGINT) AS eligible_bytes, """
    + ", ".join(f"count(*) FILTER (predicted_route = '{r}') AS route_{r.lower()}" for r in labels.ROUTES)
    + """, round(avg(e::INT::DOUBLE), 6) AS eligible_fraction, round(avg(coalesce(input_truncated, false)::INT::DOUBLE), 6) AS truncated_fraction, round(avg(input_bytes::DOUBLE), 6) AS mean_bytes,
      round(avg(coalesce(predicted_route = 'PREMIUM', false)::INT::DOUBLE), 6) AS premium_fraction, round(avg(coalesce(predicted_route = 'KEEP', false)::INT::DOUBLE), 6) AS keep_fraction,
      (SELECT string_agg(t || ':' || n, ',' ORDER BY t) FROM (SELECT t, count(*) AS n FROM typed u WHERE u.source_id IS NOT DISTINCT FROM l.source_id GROUP BY t)) AS types
      FROM (SELECT *, coalesce(predicted_route IN ('PREMIUM', 'KEEP') AND NOT input_truncated, false) AS e FROM cpt_labels) l GROUP BY source_id""",
)
def _(s, d):
    return labels.label_profile(table(s, d, "cpt_labels"))


@query(
    "route_agreement",
    """SELECT source_id, count(*) AS n, count(*) FILTER (a = b) AS agreed, count(*) FILTER (b IN ('PREMIUM', 'KEEP')) AS accepted, count(*) FILTER (a IN ('PREMIUM', 'KEEP') AND b IN ('PREMIUM', 'KEEP')) AS accepted_right
    FROM (SELECT DISTINCT source_id, row_ordinal AS ordinal, predicted_route AS a FROM cpt_labels) JOIN (SELECT DISTINCT source_id, ordinal, route AS b FROM decisions) USING (source_id, ordinal) GROUP BY source_id""",
)
def _(s, d):
    a = table(s, d, "cpt_labels").select("source_id", F.col("row_ordinal").alias("ordinal"), F.col("predicted_route").alias("route")).distinct()
    return labels.agreement(a, table(s, d, "decisions").select("source_id", "ordinal", "route").distinct(), ["source_id", "ordinal"], "source_id")


@query(
    "latest_decisions",
    """SELECT source_id, ordinal, decision, split FROM decisions QUALIFY row_number() OVER (PARTITION BY source_id, ordinal
        ORDER BY decided_at DESC NULLS LAST, split DESC NULLS LAST, decision DESC NULLS LAST, content_hash DESC NULLS LAST) = 1""",
)
def _(s, d):
    return labels.latest(table(s, d, "decisions"), ["source_id", "ordinal"], ["decided_at", "split", "decision", "content_hash"]).select("source_id", "ordinal", "decision", "split")


# Order


def _sources(s: SparkSession, d: str) -> DataFrame:
    """Documents with the number of their source in the plan; those of other sources, or none, are one more source after it."""
    plan = table(s, d, PLAN).select(F.col("id").alias("source"), "plan_idx")
    other = table(s, d, PLAN).agg(F.coalesce(F.max("plan_idx") + 1, F.lit(0))).first()[0]
    return materialize(texts(s, d).join(F.broadcast(plan), "source", "left").select("doc_id", F.coalesce("plan_idx", F.lit(other)).alias("plan_idx")), "sources")


_SOURCES = f"src AS (SELECT doc_id, coalesce(plan_idx, (SELECT max(plan_idx) + 1 FROM {PLAN}))::INT AS plan_idx, text FROM {T} t LEFT JOIN {PLAN} p ON t.source = p.id)"


@query("round_robin", f"WITH {_SOURCES} SELECT doc_id, plan_idx, row_number() OVER (ORDER BY k, plan_idx) - 1 AS pos FROM (SELECT *, row_number() OVER (PARTITION BY plan_idx ORDER BY doc_id) AS k FROM src)")
def _(s, d):
    return order.round_robin(_sources(s, d), "plan_idx", ["doc_id"]).select("doc_id", "plan_idx", "pos")


def _sql_weighted(weights: tuple[float, ...]) -> str:
    weight = "CASE " + " ".join(f"WHEN i % {len(weights)} = {k} THEN {w}::DOUBLE" for k, w in enumerate(weights)) + " END"
    return f"""WITH RECURSIVE {_SOURCES}, sizes AS (SELECT plan_idx AS i, count(*) AS n FROM src GROUP BY ALL),
    w AS (SELECT list(i ORDER BY i) AS ids, list(n ORDER BY i) AS ns, list({weight} ORDER BY i) AS ws FROM sizes),
    t AS (
      SELECT list_transform(ws, lambda x: 0.0::DOUBLE) AS score, list_transform(ws, lambda x: true) AS act, list_transform(ws, lambda x: 0::BIGINT) AS used, 0::BIGINT AS pos, NULL::INT AS pick, NULL::BIGINT AS k FROM w
      UNION ALL
      SELECT list_transform(s2, lambda x, j: CASE WHEN j = best THEN x - whole ELSE x END), list_transform(act, lambda x, j: x AND NOT (j = best AND spent)),
             list_transform(used, lambda x, j: CASE WHEN j = best AND NOT spent THEN x + 1 ELSE x END), CASE WHEN spent THEN pos ELSE pos + 1 END, CASE WHEN spent THEN NULL ELSE ids[best] END, CASE WHEN spent THEN NULL ELSE used[best] END
      FROM (SELECT *, used[best] >= ns[best] AS spent FROM (SELECT *, list_position(open, list_max(open)) AS best FROM (
        SELECT *, list_transform(s2, lambda x, j: CASE WHEN act[j] THEN x ELSE '-infinity'::DOUBLE END) AS open FROM (
          SELECT t.*, w.*, list_transform(score, lambda x, j: CASE WHEN act[j] THEN x + ws[j] ELSE x END) AS s2, list_sum(list_transform(ws, lambda x, j: CASE WHEN act[j] THEN (x * 72057594037927936.0::DOUBLE)::HUGEINT ELSE 0::HUGEINT END))::DOUBLE / 72057594037927936.0::DOUBLE AS whole
          FROM t, w WHERE list_contains(act, true)))))),
    turn AS (SELECT doc_id, plan_idx, row_number() OVER (PARTITION BY plan_idx ORDER BY doc_id) - 1 AS k FROM src)
    SELECT doc_id, plan_idx, t.pos - 1 AS pos FROM turn JOIN t ON turn.plan_idx = t.pick AND turn.k = t.k"""


def _weighted(weights: tuple[float, ...]) -> Query:
    return lambda s, d: order.weighted_round_robin(_sources(s, d), "plan_idx", ["doc_id"], {i: weights[i % len(weights)] for i in range(1000)}).select("doc_id", "plan_idx", "pos")


query("weighted_round_robin", _sql_weighted((2.0, 1.0, 0.5)))(_weighted((2.0, 1.0, 0.5)))
# sums of these never repeat as floating-point numbers
query("weighted_round_robin_odd", _sql_weighted((0.35, 0.2, 0.15, 0.3)))(_weighted((0.35, 0.2, 0.15, 0.3)))


@query("byte_budget", f"SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes FROM {T} QUALIFY sum(strlen(text)) OVER (ORDER BY doc_id) <= {BYTE_BUDGET}")
def _(s, d):
    rows = materialize(texts(s, d).select("doc_id", text.n_bytes(F.col("text")).alias("n_bytes")), "sizes")
    return order.byte_budget(rows, F.col("n_bytes"), ["doc_id"], BYTE_BUDGET)


@query("prefix_sum", f"SELECT doc_id, source, CAST(coalesce(sum(strlen(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM {T}")
def _(s, d):
    rows = materialize(texts(s, d).select("doc_id", "source", text.n_bytes(F.col("text")).alias("n_bytes")), "sizes")
    return order.prefix_sum(rows, F.col("n_bytes"), ["doc_id"], "before", by=["source"]).select("doc_id", "source", "before")


@query("resume_skip", f"SELECT doc_id, pos FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM {T}) WHERE pos >= 300")
def _(s, d):
    return order.skip_first(order.numbered(materialize(texts(s, d).select("doc_id"), "ids"), ["doc_id"]), 300)


# Mixing


def _streams(s: SparkSession, d: str) -> DataFrame:
    listed = list(MIX)
    stream = (F.array_position(F.array(*map(F.lit, listed)), F.col("lang")) - 1).alias("stream")
    return materialize(texts(s, d).filter(F.col("lang").isin(listed)).select("doc_id", "source", stream, text.n_chars(F.col("text")).alias("n")), "streams")


def _sql_mix(rows: str) -> str:
    return f"""strm AS (SELECT doc_id, source, text, CASE lang WHEN 'tr' THEN 0 ELSE 1 END AS stream, length(text) AS n FROM {rows} WHERE lang IN ('tr', 'en')),
      pre AS (SELECT *, coalesce(sum(n + 1) OVER (PARTITION BY stream ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / (CASE stream WHEN 0 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END) AS key FROM strm),
      stop AS (SELECT key AS sk, s AS ss FROM (SELECT s, coalesce((SELECT sum(n + 1) FROM strm WHERE stream = s), 0) / (CASE s WHEN 0 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END) AS key FROM (VALUES (0), (1)) v(s)) ORDER BY key, s LIMIT 1),
      mixed AS (SELECT *, row_number() OVER (ORDER BY key, stream) - 1 AS pos FROM pre, stop WHERE key < sk OR (key = sk AND stream < ss))"""


def _mixed(rows: DataFrame) -> DataFrame:
    return mixing.token_deficit_mix(rows, "stream", F.col("n"), ["doc_id"], {i: w for i, w in enumerate(MIX.values())})


@query("token_mix", f"WITH {_sql_mix(T)} SELECT doc_id, CAST(stream AS BIGINT) AS stream, pos FROM mixed")
def _(s, d):
    return _mixed(_streams(s, d)).select("doc_id", F.col("stream").cast("bigint").alias("stream"), "pos")


@query("mix_ratio", f"WITH {_sql_mix(T)} SELECT count(*) AS n_rows, coalesce(avg((stream = 0)::INT::DOUBLE), 0) AS ratio, CAST(sum(n + 1) FILTER (stream = 0) AS BIGINT) AS first_tokens, CAST(sum(n + 1) AS BIGINT) AS all_tokens FROM mixed")
def _(s, d):
    first = F.col("stream") == 0
    return _mixed(_streams(s, d)).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.avg(first.cast("double")), F.lit(0.0)).alias("ratio"), F.sum(F.when(first, F.col("n") + 1)).alias("first_tokens"), F.sum(F.col("n") + 1).alias("all_tokens"))


#: Draws of the seeded generator that SQL is given: enough for 10 times the documents of the test tables.
_DRAWS = "".join(str(int(r.random() < 0.75)) for r in [random.Random(SEED)] for _ in range(20_000))


@query(
    "bernoulli_mix",
    f"""WITH RECURSIVE bits AS (SELECT '{_DRAWS}' AS s), rws AS (SELECT doc_id, (lang IS DISTINCT FROM 'tr')::INT AS side FROM {T}),
      num AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY doc_id) - 1 AS k FROM rws), n AS (SELECT count(*) FILTER (side = 0) AS na, count(*) FILTER (side = 1) AS nb FROM rws),
      t AS (SELECT 0::BIGINT AS i, 0::BIGINT AS a, 0::BIGINT AS b, true AS la, true AS lb, NULL::INT AS side, NULL::BIGINT AS k
        UNION ALL
        SELECT i + 1, a + (pick AND NOT spent)::INT, b + (NOT pick AND NOT spent)::INT, la AND NOT (pick AND spent), lb AND NOT (NOT pick AND spent), CASE WHEN NOT spent THEN (NOT pick)::INT END, CASE WHEN NOT spent THEN CASE WHEN pick THEN a ELSE b END END
        FROM (SELECT *, CASE WHEN pick THEN a >= na ELSE b >= nb END AS spent FROM (
          SELECT t.*, n.*, CASE WHEN NOT la THEN false WHEN NOT lb THEN true ELSE substr(s, i + 1, 1) = '1' END AS pick FROM t, n, bits WHERE la OR lb)))
    SELECT doc_id, side, pos FROM num JOIN (SELECT side, k, row_number() OVER (ORDER BY i) - 1 AS pos FROM t WHERE side IS NOT NULL) USING (side, k)""",
)
def _(s, d):
    rows = materialize(texts(s, d).select("doc_id", "lang"), "streams")
    return mixing.bernoulli_mix(rows.filter("lang = 'tr'"), rows.filter("NOT (lang <=> 'tr')"), ["doc_id"]).select("doc_id", "side", "pos")


# Packing


def _sized(s: SparkSession, d: str) -> DataFrame:
    return materialize(texts(s, d).select("doc_id", "source", text.n_chars(F.col("text")).alias("n")), "sizes")


def _sql_pack(rows: str, key: str, budget: int | None = None) -> str:
    given = "given0" if budget is None else f"least(given0, {budget} - pre)"
    return f"""cost AS (SELECT *, CASE WHEN length(text) > 0 THEN length(text) + 1 ELSE 0 END AS given0 FROM {rows}),
      plc AS (SELECT *, coalesce(sum(given0) OVER (ORDER BY {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pre FROM cost),
      giv AS (SELECT *, {given} AS given FROM plc {'' if budget is None else f'WHERE pre < {budget}'}),
      chk AS (SELECT *, unnest(generate_series(pre // {LENGTH}, (pre + given - 1) // {LENGTH})) AS chunk_id FROM giv WHERE given > 0),
      cut AS (SELECT *, greatest(pre, chunk_id * {LENGTH}) - chunk_id * {LENGTH} AS off, least(pre + given, (chunk_id + 1) * {LENGTH}) - greatest(pre, chunk_id * {LENGTH}) AS m, coalesce(source, 'unknown') AS src FROM chk),
      parts AS (SELECT chunk_id, src, sum(m) AS tokens, min(off) AS first_off FROM cut GROUP BY ALL),
      major AS (SELECT chunk_id, sum(tokens)::BIGINT AS valid_length, first(src ORDER BY tokens DESC, first_off) AS source FROM parts GROUP BY ALL)"""


@query("chunk_majority", f"WITH {_sql_pack(T, 'doc_id')} SELECT chunk_id, valid_length, source FROM major")
def _(s, d):
    return packing.chunk_majority(packing.slices(packing.placed(_sized(s, d), F.col("n"), ["doc_id"])), "source")


_SOURCE_TOKENS = "SELECT c.src AS source, sum(c.m)::BIGINT AS n_tokens, coalesce(any_value(k.n), 0) AS n_chunks FROM cut c LEFT JOIN (SELECT source, count(*) AS n FROM major GROUP BY ALL) k ON c.src = k.source GROUP BY c.src"


@query("source_tokens", f"WITH {_sql_pack(T, 'doc_id')} {_SOURCE_TOKENS}")
def _(s, d):
    return packing.source_tokens(packing.slices(packing.placed(_sized(s, d), F.col("n"), ["doc_id"])), "source")


@query("pack_budget", f"WITH {_sql_pack(T, 'doc_id', TOKEN_BUDGET)} SELECT (SELECT count(*) FROM giv) AS documents, count(*) AS chunks, sum(valid_length)::BIGINT AS tokens, count(*) * {LENGTH} AS stored_tokens FROM major")
def _(s, d):
    done = packing.placed(_sized(s, d), F.col("n"), ["doc_id"], TOKEN_BUDGET)
    return done.agg(
        F.count(F.lit(1)).alias("documents"), F.ceil(F.sum("given") / LENGTH).cast("bigint").alias("chunks"), F.sum("given").alias("tokens"), (F.ceil(F.sum("given") / LENGTH) * LENGTH).cast("bigint").alias("stored_tokens")
    )


def _packed(s: SparkSession, d: str) -> DataFrame:
    return packing.pack(dealt_texts(s, d), packing.code_points(F.col("text")), "source", ["doc_id"], vocabulary=0x110000)


_TOK = "tok AS (SELECT pre, src_name, unnest(list_append(list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)), 2)) AS t, generate_subscripts(list_append(list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)), 2), 1) - 1 AS j FROM (SELECT *, coalesce(source, 'unknown') AS src_name FROM giv WHERE given > 0))"


@query(
    "packed_tokens",
    f"""WITH {_sql_pack(T, 'doc_id')}, {_TOK}
    SELECT chunk_id, valid_length, ids || repeat(',2', ({LENGTH} - valid_length)::INT) AS ids, names FROM (
      SELECT (pre + j) // {LENGTH} AS chunk_id, count(*) AS valid_length, string_agg(t, ',' ORDER BY pre + j) AS ids, md5(string_agg(src_name, ',' ORDER BY pre + j)) AS names FROM tok GROUP BY ALL)""",
)
def _(s, d):
    """All ids of each chunk, padding included, and a digest of the sources of its tokens."""
    names = F.array_join(F.slice("token_sources", F.lit(1), F.col("valid_length").cast("int")), ",")
    return _packed(s, d).select("chunk_id", "valid_length", F.array_join("tokens", ",").alias("ids"), F.md5(names).alias("names"))


@query(
    "training_examples",
    f"""WITH {_sql_pack(T, 'doc_id')}, {_TOK} SELECT chunk_id, md5(string_agg(t, ',' ORDER BY pre + j) || repeat(',-100', ({LENGTH} - count(*))::INT)) AS labels,
      repeat('1', count(*)::INT) || repeat('0', ({LENGTH} - count(*))::INT) AS mask, source FROM tok JOIN major ON (pre + j) // {LENGTH} = chunk_id GROUP BY chunk_id, source""",
)
def _(s, d):
    rows = packing.training_examples(_packed(s, d))
    return rows.select("chunk_id", F.md5(F.array_join("labels", ",")).alias("labels"), F.array_join("attention_mask", "").alias("mask"), "source")


@query(
    "file_chunks",
    f"""WITH cost AS (SELECT coalesce(source, '') AS file, doc_id, text, length(text) + 1 AS given FROM {T} WHERE length(text) > 0),
      plc AS (SELECT *, sum(given) OVER (PARTITION BY file ORDER BY doc_id) - given AS pre FROM cost),
      tok AS (SELECT file, pre, unnest(list_append(list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)), 2)) AS t, generate_subscripts(list_append(list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)), 2), 1) - 1 AS j FROM plc)
    SELECT file, CAST((pre + j) // {LENGTH} AS BIGINT) AS chunk, md5(string_agg(t, ',' ORDER BY pre + j) || repeat(',2', ({LENGTH} - count(*))::INT)) AS ids FROM tok GROUP BY file, chunk HAVING count(*) >= {LENGTH // 2}""",
)
def _(s, d):
    """The chunks of every source packed as a file of its own."""
    docs = texts(s, d).select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text")
    return packing.pack_per_file(docs, packing.code_points(F.col("text")), "source", ["doc_id"]).select("file", "chunk", F.md5(F.array_join("tokens", ",")).alias("ids"))


@query(
    "pack_per_file",
    f"SELECT source, CAST(t // {LENGTH} + (t % {LENGTH} >= {LENGTH // 2})::INT AS BIGINT) AS chunks, t % {LENGTH} > 0 AND t % {LENGTH} >= {LENGTH // 2} AS kept_tail FROM (SELECT source, sum(CASE WHEN length(text) > 0 THEN length(text) + 1 ELSE 0 END)::BIGINT AS t FROM {T} GROUP BY ALL)",
)
def _(s, d):
    return packing.per_file_chunks(_sized(s, d), F.col("n"), "source", ["doc_id"])


@query(
    "train_counters",
    f"""WITH {_sql_pack(T, 'doc_id')}, run AS (SELECT greatest(0, least(valid_length, {TOKEN_BUDGET} - coalesce(sum(valid_length) OVER (ORDER BY chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS v FROM major)
    SELECT sum(v)::BIGINT AS attended, sum(v - 1)::BIGINT AS loss_tokens, count(*) AS n_rows FROM run WHERE v > 0""",
)
def _(s, d):
    cut = packing.slices(packing.placed(_sized(s, d), F.col("n"), ["doc_id"]))
    return metrics.training_counters(packing.chunk_majority(cut, "source").select("chunk_id", "valid_length"), TOKEN_BUDGET)


@query("source_samples", f"WITH {_sql_pack(T, 'doc_id')} SELECT src AS source, sum(tokens)::BIGINT AS tokens, count(*) AS samples FROM parts GROUP BY ALL")
def _(s, d):
    """Tokens of each source, and the chunks in which it has one."""
    cut = packing.slices(packing.placed(_sized(s, d), F.col("n"), ["doc_id"]))
    return packing.chunk_sources(cut, "source").groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("samples"))


# Scores and sizes


@query("perplexity", "SELECT event_type, (100 * count(*))::BIGINT AS n_tokens, round(exp(sum(floor(abs(value)))::DOUBLE / (100 * count(*))), 6) AS perplexity FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL")
def _(s, d):
    rows = table(s, d, "events").filter(F.col("value").isNotNull() & ~F.isnan("value")).select("event_type", F.floor(F.abs("value")).cast("double").alias("nll"), F.lit(100).cast("bigint").alias("n"))
    return metrics.perplexity(rows, "nll", "n", ["event_type"]).withColumn("perplexity", F.round("perplexity", 6))


def _scored(s: SparkSession, d: str) -> DataFrame:
    """Answers made from the cases: right, right in prose, without an object, and with another value."""
    kind = F.ascii(F.right("id", F.lit(1))) % 4
    answer = F.when(kind == 0, F.col("expected")).when(kind == 1, F.concat(F.lit("Yanit: "), F.col("expected"))).when(kind == 2, F.lit("?")).otherwise(F.lit('{"cevap": 0}'))
    rows = table(s, d, "contract_cases_v1").select("id", "category", answer.alias("response"), "expected")
    return metrics.score_answers(rows, "response", "expected").drop("response", "expected")


_ONE_NUMBER = "(json_keys(e) = ['cevap'] AND json_type(e, '$.cevap') IN ('UBIGINT', 'BIGINT'))"
_SCORED = f"""cases AS (SELECT id, category, ascii(right(id, 1)) % 4 AS kind, expected::JSON AS e FROM contract_cases_v1),
  flags AS (SELECT id, category, kind IN (0, 3) AS json_parse_valid, CASE kind WHEN 0 THEN true WHEN 3 THEN {_ONE_NUMBER} ELSE false END AS schema_valid,
    CASE WHEN kind IN (0, 1) THEN true WHEN kind = 3 THEN {_ONE_NUMBER} AND e->>'$.cevap' = '0' END AS task_correct FROM cases),
  scored AS (SELECT id, category, task_correct, json_parse_valid, schema_valid, coalesce(schema_valid AND task_correct, false) AS contract_and_task_correct FROM flags)"""


@query("contract_scores", f"WITH {_SCORED} SELECT * FROM scored")
def _(s, d):
    return _scored(s, d)


@query("contract_summary", f"WITH {_SCORED} SELECT " + ", ".join(f"count(*) FILTER ({f}) AS {f}" for f in metrics.FLAGS) + ", count(*) FILTER (task_correct IS NULL) AS semantic_unscored, count(*) AS total FROM scored")
def _(s, d):
    return metrics.score_summary(_scored(s, d))


@query("size_shares", f"SELECT source, count(*) AS n, sum(strlen(text))::BIGINT AS size, round(100.0 * sum(strlen(text))::DOUBLE / (SELECT sum(strlen(text)) FROM {T})::DOUBLE, 4) AS percent FROM {T} GROUP BY ALL")
def _(s, d):
    return metrics.size_shares(texts(s, d), "source", text.n_bytes(F.col("text")))


@query("dominant_language", "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY ALL ORDER BY n DESC, min(doc_id) LIMIT 1")
def _(s, d):
    return metrics.dominant(table(s, d, "documents"), "lang", "doc_id")


def _shards(s: SparkSession, d: str) -> list[tuple[str, int]]:
    """Sources as files with the bytes of their texts; one row per source."""
    rows = texts(s, d).filter(F.col("source").isNotNull()).groupBy("source").agg(F.sum(text.n_bytes(F.col("text"))).alias("n")).orderBy("source").collect()
    return [(r["source"], r["n"]) for r in rows]


def _dealt(s: SparkSession, groups: list[list[tuple[str, int]]]) -> DataFrame:
    return s.createDataFrame([(g + 1, p, n) for g, files in enumerate(groups) for p, n in files], "phase bigint, path string, size bigint")


_SHARDS = f"sh AS (SELECT source AS path, sum(strlen(text))::BIGINT AS size FROM {T} WHERE source IS NOT NULL GROUP BY source)"


@query(
    "shards_contiguous",
    f"""WITH RECURSIVE {_SHARDS}, f AS (SELECT *, row_number() OVER (ORDER BY path) AS i FROM sh), t AS (SELECT sum(size)::BIGINT AS whole, count(*) AS n FROM f),
    r AS (SELECT 0::BIGINT AS i, 1::BIGINT AS g, 0::BIGINT AS held, 1::BIGINT AS mine UNION ALL
      SELECT i, CASE WHEN shut THEN g + 1 ELSE g END, CASE WHEN shut THEN 0 ELSE h END, g FROM (
        SELECT f.i, r.g, r.held + f.size AS h, r.g < 4 AND (n - f.i = 4 - r.g OR ((r.held + f.size) * 4 >= whole AND n - f.i >= 4 - r.g)) AS shut FROM r JOIN f ON f.i = r.i + 1, t))
    SELECT r.mine AS phase, path, size FROM r JOIN f ON r.i = f.i""",
)
def _(s, d):
    return _dealt(s, partition.contiguous(_shards(s, d), 4))


@query(
    "shards_largest_first",
    f"""WITH RECURSIVE {_SHARDS}, f AS (SELECT *, row_number() OVER (ORDER BY size DESC, path) AS i FROM sh),
    r AS (SELECT 0::BIGINT AS i, [0, 0, 0, 0]::BIGINT[] AS loads, NULL::BIGINT AS g UNION ALL
      SELECT i, list_transform(loads, lambda x, j: CASE WHEN j = g THEN x + size ELSE x END), g FROM (SELECT f.i, f.size, r.loads, list_position(r.loads, list_min(r.loads))::BIGINT AS g FROM r JOIN f ON f.i = r.i + 1))
    SELECT r.g AS phase, path, size FROM r JOIN f ON r.i = f.i""",
)
def _(s, d):
    return _dealt(s, partition.largest_first(_shards(s, d), 4))


# The whole way

_FIRST = f"(SELECT * FROM {T} QUALIFY doc_id = min(doc_id) OVER (PARTITION BY sha256(text)))"


@query("flagship", f"WITH {_sql_mix(f'(SELECT * FROM {_FIRST} WHERE ' + _sql_split('sha256(text)') + chr(61) + chr(39) + 'train' + chr(39) + ')')}, {_sql_pack('mixed', 'pos')} {_SOURCE_TOKENS}")
def flagship(s: SparkSession, d: str) -> DataFrame:
    """First copies of the train split, mixed by language to token shares and packed: tokens and chunks by source.

    Only lengths go through the shuffles; texts are hashed and measured where they are read.
    """
    docs = materialize(texts(s, d).select("doc_id", "source", "lang", identity.document_hash(F.col("text")).alias("content_hash"), text.n_chars(F.col("text")).alias("n")), "hashed")
    first = labels.first_copies(docs, "content_hash", ["doc_id"], F.lit(True)).filter("is_first").filter(_split(F.col("content_hash")) == "train")
    listed = F.array(*map(F.lit, MIX))
    streams = first.filter(F.col("lang").isin(list(MIX))).withColumn("stream", F.array_position(listed, F.col("lang")) - 1)
    # cut here: the steps below pass over the stream several times
    mixed = materialize(_mixed(materialize(streams.select("doc_id", "source", "stream", "n"), "streams")).select("pos", "source", "n"), "mixed")
    return packing.source_tokens(packing.slices(packing.placed(mixed, F.col("n"), ["pos"])), "source")
