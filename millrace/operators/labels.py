"""Label tables: validation, join with raw rows, decisions, first copies and audit counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.identity import content_split, document_hash, document_id

ROUTES = ("PREMIUM", "KEEP", "REVIEW", "DETERMINISTIC_REPAIR", "MODEL_REPAIR", "DROP")
CLEAN_ROUTES = ("PREMIUM", "KEEP")


class IntegrityError(ValueError):
    """A table breaks a rule; the message names the first violation."""


def is_json_object(c: Column) -> Column:
    """Whether a string holds a JSON object; null counts as none."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False))


def label_violation(sources: Iterable[str], routes: Iterable[str] = ROUTES) -> Column:
    """The first rule that a label row breaks, or null. ``sources`` are the ids of the plan."""
    return (
        F.when(F.col("source_id").isNull() | ~F.col("source_id").isin(*sources), "unknown_source")
        .when(F.col("row_ordinal").isNull() | (F.col("row_ordinal") < 0), "bad_ordinal")
        .when(F.col("predicted_route").isNull() | ~F.col("predicted_route").isin(*routes), "unknown_route")
        .when(F.col("doc_id").isNull() | F.col("document_hash").isNull(), "missing_identity")
        .when(F.col("input_truncated").isNull(), "bad_truncated")
        .when(F.col("input_bytes").isNull() | (F.col("input_bytes") < 0), "bad_bytes")
        .when(~is_json_object(F.col("predicted_label_json")), "bad_label")
    )


def validate_labels(labels: DataFrame, sources: Iterable[str]) -> DataFrame:
    """Label rows with ``violation``; rows without one may still share a coordinate."""
    return labels.withColumn("violation", label_violation(list(sources)))


def repeated_coordinates(labels: DataFrame) -> DataFrame:
    """(source_id, row_ordinal, n) of coordinates labelled more than once."""
    return labels.groupBy("source_id", "row_ordinal").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_valid_labels(labels: DataFrame, sources: Iterable[str], most: int | None = None) -> None:
    """Raise IntegrityError for the violation of the smallest coordinate, a repeated coordinate, an empty table or too many rows."""
    bad = validate_labels(labels, sources).filter(F.col("violation").isNotNull()).orderBy("source_id", "row_ordinal", "violation").limit(1).collect()
    if bad:
        raise IntegrityError(f"{bad[0]['violation']} at {bad[0]['source_id']}:{bad[0]['row_ordinal']}")
    again = repeated_coordinates(labels).orderBy("source_id", "row_ordinal").limit(1).collect()
    if again:
        raise IntegrityError(f"repeated label at {again[0]['source_id']}:{again[0]['row_ordinal']}")
    n = labels.count()
    if not n:
        raise IntegrityError("no labels")
    if most is not None and n > most:
        raise IntegrityError(f"{n} labels are more than {most}")


def require_plan(plan: DataFrame) -> None:
    """Raise IntegrityError unless every plan row is complete, pinned and has an id of its own. One row per source."""
    seen: set[str] = set()
    for r in plan.orderBy("plan_idx").collect():
        for field in ("id", "repo", "revision", "config", "split", "text_field", "license"):
            if not r[field]:
                raise IntegrityError(f"source {r['id']} lacks {field}")
        if len(r["revision"]) != 40 or set(r["revision"]) - set("0123456789abcdef"):
            raise IntegrityError(f"source {r['id']} has no pinned revision")
        if r["id"] in seen:
            raise IntegrityError(f"source id {r['id']} stands twice")
        seen.add(r["id"])


def raw_texts(upstream: DataFrame, plan: DataFrame) -> DataFrame:
    """(source_id, plan_idx, ordinal, repo, revision, config, split, text) of raw rows.

    The plan has one row per source and is broadcast; rows outside it are left out.
    """
    p = plan.select("plan_idx", F.col("id").alias("source_id"), *[F.col(c).alias(f"p_{c}") for c in ("repo", "revision", "config", "split")])
    u = upstream.select(*[F.col(f"source.{c}").alias(c) for c in ("repo", "revision", "config", "split")], "ordinal", "text")
    same = [F.col(c) == F.col(f"p_{c}") for c in ("repo", "revision", "config", "split")]
    joined = u.join(F.broadcast(p), same[0] & same[1] & same[2] & same[3])
    return joined.select("source_id", "plan_idx", "ordinal", "repo", "revision", "config", "split", "text")


def raw_rows(upstream: DataFrame, plan: DataFrame) -> DataFrame:
    """What the identity check needs of each raw row: (source_id, plan_idx, ordinal, has_text, content_hash, document_id, n_bytes); exact repeats once.

    Texts are hashed and measured where they are read, and go no further.
    """
    hashed = raw_texts(upstream, plan).withColumn("content_hash", document_hash(F.col("text")))
    coordinates = [F.col(c) for c in ("repo", "revision", "config", "split", "ordinal")]
    return hashed.select(
        "source_id",
        "plan_idx",
        "ordinal",
        F.coalesce(F.col("text") != "", F.lit(False)).alias("has_text"),
        "content_hash",
        document_id(*coordinates, digest=F.col("content_hash")).alias("document_id"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
    ).distinct()


def raw_keys(upstream: DataFrame, plan: DataFrame) -> DataFrame:
    """(source_id, plan_idx, ordinal) of raw rows, without reading texts."""
    return raw_texts(upstream, plan).select("source_id", "plan_idx", "ordinal")


def join_labels(raw: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled raw rows (see raw_rows) with what the identity check finds.

    ``text_ok`` (a text that isn't empty), ``hash_ok``, ``id_ok`` and
    ``bytes_ok`` compare the row with its label; ``violation`` names the first
    that fails.
    """
    label = labels.select(F.col("source_id").alias("l_source_id"), "row_ordinal", F.col("doc_id").alias("l_doc_id"), F.col("document_hash").alias("l_hash"), "input_bytes", "input_truncated", "predicted_label_json", "predicted_route")
    joined = raw.join(label, (F.col("source_id") == F.col("l_source_id")) & (F.col("ordinal") == F.col("row_ordinal"))).drop("l_source_id", "row_ordinal")
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    checked = (
        joined.withColumn("text_ok", F.col("has_text"))
        .withColumn("hash_ok", same("content_hash", "l_hash"))
        .withColumn("id_ok", same("document_id", "l_doc_id"))
        .withColumn("bytes_ok", same("n_bytes", "input_bytes"))
    )
    return checked.withColumn(
        "violation", F.when(~F.col("text_ok"), "text").when(~F.col("hash_ok"), "hash").when(~F.col("id_ok"), "doc_id").when(~F.col("bytes_ok"), "bytes")
    )


def require_identity(joined: DataFrame) -> None:
    """Raise IntegrityError for the violation of the smallest coordinate in plan order."""
    bad = joined.filter(F.col("violation").isNotNull()).orderBy("plan_idx", "ordinal").limit(1).collect()
    if bad:
        raise IntegrityError(f"{bad[0]['violation']} differs at {bad[0]['source_id']}:{bad[0]['ordinal']}")


def missing_rows(raw: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels whose raw row doesn't exist."""
    keys = raw.select(F.col("source_id").alias("r_source_id"), "ordinal")
    return labels.join(keys, (F.col("source_id") == F.col("r_source_id")) & (F.col("row_ordinal") == F.col("ordinal")), "left_anti")


def unlabelled_rows(raw: DataFrame, labels: DataFrame) -> DataFrame:
    keys = labels.select(F.col("source_id").alias("l_source_id"), "row_ordinal")
    return raw.join(keys, (F.col("source_id") == F.col("l_source_id")) & (F.col("ordinal") == F.col("row_ordinal")), "left_anti")


def first_copies(df: DataFrame, key: str, order: list[str], eligible: Column, out: str = "is_first") -> DataFrame:
    """Add ``out``: whether an eligible row is the first of its key among eligible rows; false for the others.

    The winner of each key is a partial minimum, and rows meet the winners by
    their place, which must be unique; so a key that holds many rows is no hot
    spot anywhere.
    """
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    winners = df.filter(eligible & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_first")).select("_first")
    joined = df.join(winners, place == F.col("_first"), "left")
    return joined.withColumn(out, F.col("_first").isNotNull()).drop("_first")


def decide(rows: DataFrame, order: list[str], accepted: Iterable[str] = CLEAN_ROUTES, gated: Iterable[str] = (), fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """Add ``decision`` and ``split`` to labelled rows.

    In this order: excluded_route, review_gate (a source held back),
    truncated_input_review, duplicate (not the first eligible row of its
    content) and accepted. Rows that aren't eligible never shadow a later copy.
    """
    accepted, gated = list(accepted), list(gated)
    if not set(accepted) <= set(CLEAN_ROUTES):
        raise ValueError("only clean routes can be accepted")
    excluded = ~F.coalesce(F.col("predicted_route").isin(accepted), F.lit(False))
    held = F.col("source_id").isin(gated) if gated else F.lit(False)
    truncated = F.coalesce(F.col("input_truncated"), F.lit(False))
    marked = first_copies(rows, "content_hash", order, ~excluded & ~held & ~truncated)
    decision = F.when(excluded, "excluded_route").when(held, "review_gate").when(truncated, "truncated_input_review").when(F.col("is_first"), "accepted").otherwise("duplicate")
    return marked.withColumn("decision", decision).withColumn("split", content_split(F.col("content_hash"), fraction, seed)).drop("is_first")


def audit(decided: DataFrame) -> DataFrame:
    """Rows by route, decision and split."""
    return decided.groupBy(F.col("predicted_route").alias("route"), "decision", "split").agg(F.count(F.lit(1)).alias("n"))


def label_profile(labels: DataFrame) -> DataFrame:
    """Rows, truncated and eligible rows, their bytes and fractions, and the histograms of routes and types, by source.

    ``types`` lists the label's types as read (lower case, '' where there is none) with their counts, in their order.
    """
    clean = F.col("predicted_route").isin(*CLEAN_ROUTES) & ~F.col("input_truncated")
    eligible = F.coalesce(clean, F.lit(False))
    kind = F.coalesce(F.lower(F.trim(F.try_variant_get(F.try_parse_json("predicted_label_json"), "$.type", "string"))), F.lit(""))
    counted = labels.groupBy("source_id", kind.alias("type")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("input_truncated")).alias("truncated"),
        F.count_if(eligible).alias("eligible"),
        F.sum(F.when(eligible, F.col("input_bytes"))).alias("eligible_bytes"),
        F.sum("input_bytes").alias("bytes"),
        F.count("input_bytes").alias("sized"),
        *[F.count_if(F.col("predicted_route") == r).alias(f"route_{r.lower()}") for r in ROUTES],
    )
    share = lambda c: F.round(F.col(c) / F.col("sampled_rows"), 6)
    return (
        counted.groupBy("source_id")
        .agg(
            F.sum("n").alias("sampled_rows"),
            F.sum("truncated").alias("truncated"),
            F.sum("eligible").alias("eligible"),
            F.coalesce(F.sum("eligible_bytes"), F.lit(0)).alias("eligible_bytes"),
            F.round(F.sum("bytes") / F.sum("sized"), 6).alias("mean_bytes"),
            *[F.sum(f"route_{r.lower()}").alias(f"route_{r.lower()}") for r in ROUTES],
            F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("type", "n"))), lambda x: F.concat_ws(":", x["type"], x["n"].cast("string")))).alias("types"),
        )
        .withColumns({"eligible_fraction": share("eligible"), "truncated_fraction": share("truncated"), **{f"{r.lower()}_fraction": share(f"route_{r.lower()}") for r in CLEAN_ROUTES}})
    )


def agreement(a: DataFrame, b: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Of rows that two judges (columns ``keys``, route) share: exact agreement, and precision of b's acceptance against a's."""
    left = a.select(*keys, F.col("route").alias("_a"))
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("route").alias("_b"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    clean_a, clean_b = F.col("_a").isin(*CLEAN_ROUTES), F.col("_b").isin(*CLEAN_ROUTES)
    return left.join(right, on).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_a") == F.col("_b")).alias("agreed"),
        F.count_if(clean_b).alias("accepted"),
        F.count_if(clean_a & clean_b).alias("accepted_right"),
    )


def seen_index(decided: DataFrame) -> DataFrame:
    """(hash, source_id, ordinal): the owner of each accepted hash."""
    return decided.filter(F.col("decision") == "accepted").select(F.col("content_hash").alias("hash"), "source_id", "ordinal")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
