"""The whole way from raw rows and labels to a token cache.

    labels x raw rows -> checks -> sources in turn -> decisions -> one split
    secondary texts -> score -> same split -> byte budget
    both -> mix to token shares (or seeded draws, cleaned) -> packed chunks -> cache, audit

Texts are encoded once; mixing and packing use the numbers of tokens.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import config as settings
from millrace.functions import text as X
from millrace.functions.identity import content_split, document_hash
from millrace.operators import labels as L
from millrace.operators import mixing, order, packing, tokenize
from millrace.sources import sinks
from millrace.sources.cache import content_digest, input_digest, known_cache, write_cache
from millrace.storage import materialize


@dataclass
class Rules:
    """What decides which texts are taken, and how they are mixed and packed."""

    split: str = "train"
    fraction: float = 0.01
    seed: int = 42
    accepted: Sequence[str] = L.CLEAN_ROUTES
    gated: Sequence[str] = ()
    weights: dict[int, float] = field(default_factory=dict)
    primary_ratio: float = 0.8
    unit: str = "tokens"
    least_chars: int = 50
    most_chars: int = 1_000_000
    length: int = 2048
    max_tokens: int | None = None
    chunks_per_shard: int = 8192
    max_labels: int | None = None


@dataclass
class Secondary:
    """A further source: texts with a numeric order, a share among the secondary sources, and what bounds it."""

    name: str
    rows: DataFrame  # key bigint, text string, score string
    weight: float = 1.0
    score_gte: float | None = None
    target_gb: float | None = None


def decided_rows(upstream: DataFrame, plan: DataFrame, labels: DataFrame, rules: Rules) -> DataFrame:
    """All labelled rows with decision, split and pos, without their texts; an inconsistency raises IntegrityError."""
    L.require_plan(plan)
    ids = [r["id"] for r in plan.select("id").collect()]  # one row per source
    L.require_valid_labels(labels, ids, rules.max_labels)
    raw = L.raw_rows(upstream, plan)
    missing = L.missing_rows(L.raw_keys(upstream, plan), labels).orderBy("source_id", "row_ordinal").limit(1).collect()
    if missing:
        raise L.IntegrityError(f"no raw row at {missing[0]['source_id']}:{missing[0]['row_ordinal']}")
    joined = materialize(L.join_labels(raw, labels), "joined")
    L.require_identity(joined)
    in_turn = order.weighted_round_robin(joined, "plan_idx", ["ordinal"], rules.weights)
    return L.decide(in_turn, ["pos"], rules.accepted, rules.gated, rules.fraction, rules.seed)


def accepted_texts(decided: DataFrame, split: str, texts: DataFrame) -> DataFrame:
    """(key, text) of the accepted rows of one split ('all' for every split), with the texts (see labels.raw_texts) of just these."""
    kept = decided.filter(F.col("decision") == "accepted")
    kept = kept if split == "all" else kept.filter(F.col("split") == split)
    chosen = kept.select(F.col("pos").alias("key"), F.col("source_id").alias("s"), F.col("ordinal").alias("o"))
    # a raw row that stands twice has one text, as its identity was checked
    found = texts.select("source_id", "ordinal", "text").join(chosen, (F.col("source_id") == F.col("s")) & (F.col("ordinal") == F.col("o")))
    return found.groupBy("key").agg(F.first("text").alias("text"))


def secondary_texts(source: Secondary, rules: Rules) -> DataFrame:
    """(key, text): rows that reach the score and lie in the split, up to the byte budget."""
    rows = source.rows
    if source.score_gte is not None:
        rows = rows.filter(X.score_at_least(F.col("score"), source.score_gte))
    rows = rows.filter(~X.is_blank(F.col("text"))).select("key", "text")
    if rules.split != "all":
        rows = rows.filter(content_split(document_hash(F.col("text")), rules.fraction, rules.seed) == rules.split)
    return rows if source.target_gb is None else order.byte_budget(rows, X.n_bytes(F.col("text")), ["key"], X.gigabytes(source.target_gb))


def secondary_counters(source: Secondary, rules: Rules) -> DataFrame:
    """One row of a secondary source: its rows, those refused by score, as blank and by split, those over the byte budget, and the accepted rows and bytes."""
    rows = source.rows
    low = ~X.score_at_least(F.col("score"), source.score_gte) if source.score_gte is not None else F.lit(False)
    other = F.lit(False) if rules.split == "all" else content_split(document_hash(F.col("text")), rules.fraction, rules.seed) != rules.split
    state = F.when(low, "low_score").when(X.is_blank(F.col("text")), "blank").when(other, "other_split").otherwise("fits")
    marked = rows.select("key", X.n_bytes(F.col("text")).alias("n_bytes"), state.alias("state"))
    fits = marked.filter("state = 'fits'")
    taken = fits if source.target_gb is None else order.byte_budget(fits, F.col("n_bytes"), ["key"], X.gigabytes(source.target_gb))
    states = marked.select("state", "n_bytes").unionByName(taken.select(F.lit("accepted").alias("state"), "n_bytes"))
    n = lambda s: F.count_if(F.col("state") == s)
    return states.agg(
        F.count_if(F.col("state") != "accepted").alias("n_rows"),
        *[n(s).alias(s) for s in ("low_score", "blank", "other_split")],
        (n("fits") - n("accepted")).alias("over_budget"),
        n("accepted").alias("accepted"),
        F.coalesce(F.sum(F.when(F.col("state") == "accepted", F.col("n_bytes"))), F.lit(0)).alias("accepted_bytes"),
    ).select(F.lit(source.name).alias("source"), "*")


def round_robin_texts(sources: Sequence[DataFrame]) -> DataFrame:
    """Several (key, text) streams as one, a text of each in turn."""
    tagged = [s.withColumn("which", F.lit(i).cast("bigint")) for i, s in enumerate(sources)]
    whole = tagged[0]
    for t in tagged[1:]:
        whole = whole.unionByName(t)
    return order.round_robin(whole, "which", ["key"], "pos").select(F.col("pos").alias("key"), "text")


def mixed_tokens(primary: DataFrame, secondary: Sequence[tuple[DataFrame, float]], tokenizer, rules: Rules, phase: int = 0) -> DataFrame:
    """(pos, source, tokens) of the mixed stream, 'primary' and 'secondary' by name.

    With unit 'tokens' the streams are balanced by tokens and keep their text
    as it is; with unit 'texts' they are drawn by a seed, and cleaned.
    """
    if rules.unit == "tokens":
        if secondary and not 0 < rules.primary_ratio < 1:
            raise ValueError("the primary ratio must lie between 0 and 1")
        share = sum(w for _, w in secondary)
        streams = [primary, *[s for s, _ in secondary]]
        weights = [rules.primary_ratio if secondary else 1.0, *[(1 - rules.primary_ratio) * w / share for _, w in secondary]]
        rows = None
        for i, s in enumerate(streams):
            tagged = s.select("key", "text", F.lit(i).cast("bigint").alias("stream"))
            rows = tagged if rows is None else rows.unionByName(tagged)
        coded = materialize(tokenize.encode(rows, "text", tokenizer).drop("text"), "tokens")
        mixed = mixing.token_deficit_mix(coded.withColumn("n", F.size("tokens")), "stream", F.col("n"), ["key"], dict(enumerate(weights)))
        return mixed.select("pos", F.when(F.col("stream") == 0, "primary").otherwise("secondary").alias("source"), "tokens")
    other = round_robin_texts([s for s, _ in secondary]) if secondary else primary.limit(0)
    drawn = mixing.bernoulli_mix(primary, other, ["key"], rules.primary_ratio, rules.seed + phase)
    fits = drawn.filter(F.length("text") <= rules.most_chars).withColumn("text", X.clean_text(X.strip_end_marker(F.col("text"))))
    kept = fits.filter(F.length("text") >= rules.least_chars).select("pos", F.when(F.col("side") == 0, "primary").otherwise("secondary").alias("source"), "text")
    return materialize(tokenize.encode(kept, "text", tokenizer).drop("text"), "tokens")


def prepare_token_cache(spark: SparkSession, upstream: DataFrame, plan: DataFrame, labels: DataFrame, secondary: Sequence[Secondary], tokenizer, path: str, rules: Rules, phase: int = 1, rebuild: bool = False) -> dict:
    """Write the cache of one phase and its audit below ``path``; returns the cache's manifest.

    A complete cache of the same rules, phase, tokenizer and inputs is returned
    as it is; one of others is an error, before anything is written.
    """
    identity = {
        "phase": phase,
        "upstream": input_digest(upstream),
        "plan": content_digest(plan),
        "labels": content_digest(labels),
        "split": rules.split,
        "tokenizer": tokenize.fingerprint(tokenizer),
        "rules": settings.fingerprint({k: v for k, v in vars(rules).items()}),
        "secondary": [[s.name, s.weight, s.score_gte, s.target_gb, input_digest(s.rows)] for s in secondary],
    }
    place = f"{path}/{settings.cache_name(phase, rules.split)}"
    known = None if rebuild else known_cache(spark, place, identity, rules.length)
    if known:
        return known
    decided = materialize(decided_rows(upstream, plan, labels, rules), "decided")
    sinks.write_audit(decided, f"{path}/audit", settings.fingerprint(identity), replace=rebuild)
    streams = [(secondary_texts(s, rules), s.weight) for s in secondary]
    mixed = mixed_tokens(accepted_texts(decided, rules.split, L.raw_texts(upstream, plan)), streams, tokenizer, rules, phase)
    end, pad = tokenize.special_ids(tokenizer)
    chunks = packing.pack(mixed, F.col("tokens"), "source", ["pos"], rules.length, end, pad, rules.max_tokens)
    return write_cache(chunks, place, identity, rules.length, rules.chunks_per_shard, rebuild=rebuild)
