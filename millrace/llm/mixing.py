"""Mixing sources to target shares of the total size.

Weighted sampling without replacement after Efraimidis and Spirakis: a record
with weight w gets the key -ln(u) / w, u uniform from a hash of its
coordinate, and the records with the smallest keys are a weighted sample. A
source whose target exceeds its size is first used whole, in complete epochs
(at most ``max_uses`` in all); the rest of its target is the prefix of its
records in key order.

No source is sorted: quantiles of its keys cut it into buckets of about equal
rows, whatever the weights, the bucket sums give the one in which the target
ends, that one is cut again until it is small, and only its rows are ordered.

Results: without a given total the mixture is the largest in which every
source with usable records reaches its share within ``max_uses``. With a
larger total the sources that are too small are used ``max_uses`` times and
fall short, which the shares show. Null, zero and negative quotas and sources
without usable records contribute nothing; records with null or empty text are
not usable; repeated rows of one coordinate are one record; a record without a
readable label has the middle weight. The record at the end of the target is
taken if that brings the sum nearer to it.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import label_fields, with_plan_id
from millrace.storage import materialize

MAX_USES = 4
#: Rows of a source that are ordered in one task, and the buckets of one cut.
ROWS_PER_BUCKET, BUCKETS = 20_000, 64


def quality_weight() -> F.Column:
    """0.1 .. 1 from utility and fluency (0..4) and noise (0..1); 0.5 without them."""
    good = (F.col("utility") + F.col("fluency")) / 8 * (1 - F.col("noise"))
    w = 0.1 + 0.9 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), good))
    return F.when(good.isNull() | F.isnan(good), F.lit(0.5)).otherwise(w)


def budgets(sizes: dict[str, int], quotas: dict[str, int | None], total: int | None = None, max_uses: int = MAX_USES) -> dict[str, tuple[int, int]]:
    """(complete epochs, bytes still to be taken) of each source; the work of one row per plan entry."""
    live = {k: q for k, q in quotas.items() if q and q > 0 and sizes.get(k, 0) > 0}
    whole = sum(live.values())
    if not live:
        return {}
    if total is None:
        total = int(min(Fraction(max_uses * sizes[k] * whole, q) for k, q in live.items()))
    out = {}
    for k, q in live.items():
        target = Fraction(q * total, whole)
        epochs = min(max_uses, int(target // sizes[k]))
        out[k] = (epochs, 0 if epochs == max_uses else round(target - epochs * sizes[k]))
    return out


def _edges(keyed: DataFrame, rests: dict[str, int], rows: dict[str, int]) -> dict[str, tuple[float, float, int]]:
    """Of each source, the range of keys (low, high] of at most ROWS_PER_BUCKET rows in which its rest of bytes is reached, and the bytes up to low.

    Each pass cuts the ranges that are still too large; what comes to the
    driver is BUCKETS rows per plan entry.
    """
    spark = keyed.sparkSession
    edges = {k: (float("-inf"), float("inf"), 0) for k in rests}
    large = {k for k in rests if rows[k] > ROWS_PER_BUCKET}
    while large:
        ranges = spark.createDataFrame([(k, *edges[k][:2]) for k in large], "id string, low double, high double")
        held = keyed.join(F.broadcast(ranges), "id").filter((F.col("key") > F.col("low")) & (F.col("key") <= F.col("high")))
        cuts = held.groupBy("id").agg(F.percentile_approx("key", [i / BUCKETS for i in range(1, BUCKETS)], 20 * BUCKETS).alias("cuts"))
        bucket = F.size(F.filter("cuts", lambda c: c < F.col("key")))
        sums = held.join(F.broadcast(cuts), "id").groupBy("id", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b"), F.max("key").alias("last"))
        found = {k: sorted((r["bucket"], r["n"], r["b"], r["last"]) for r in group) for k, group in groupby(sorted(sums.collect(), key=lambda r: r["id"]), lambda r: r["id"])}
        for k in list(large):
            low, high, before = edges[k]
            for _, n, size, last in found[k]:
                if before + size > rests[k] or last == found[k][-1][3]:
                    break
                low, before = last, before + size
            edges[k] = (low, last, before)
            # equal keys can't be cut
            if n <= ROWS_PER_BUCKET or len(found[k]) == 1:
                large.discard(k)
    return edges


def mix(records: DataFrame, quotas: dict[str, int | None], total: int | None = None, max_uses: int = MAX_USES, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Choose from ``records`` (id, ordinal, n_bytes, weight), one row per record.

    Returns the chosen records (id, ordinal, n_bytes, repeats) and the sources
    (id, available_bytes, target_share, reachable_share, actual_bytes,
    actual_share, records, largest_repeat). Both are as small as the plan or
    as the choice; sizes by source are at most one row per plan entry.
    """
    spark = records.sparkSession
    u = (F.pmod(F.xxhash64(F.lit(seed), "id", "ordinal"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = materialize(records.filter(F.col("n_bytes") > 0).select("id", "ordinal", "n_bytes", (-F.log(u) / F.col("weight")).alias("key")), "mix")
    stat = {r["id"]: (r["b"], r["n"]) for r in keyed.groupBy("id").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect() if r["id"] in quotas}
    sizes = {k: b for k, (b, _) in stat.items()}
    chosen_plan = budgets(sizes, quotas, total, max_uses)
    edges = _edges(keyed, {k: rest for k, (_, rest) in chosen_plan.items()}, {k: n for k, (_, n) in stat.items()})
    # one row per plan entry
    goal = spark.createDataFrame([(k, e, r, *edges[k]) for k, (e, r) in chosen_plan.items()], "id string, epochs int, rest bigint, low double, high double, before bigint")
    aimed = keyed.join(F.broadcast(goal), "id")
    at_edge = (F.col("key") > F.col("low")) & (F.col("key") <= F.col("high"))
    inside = aimed.filter(~at_edge).withColumn("more", (F.col("key") <= F.col("low")).cast("int"))
    running = F.sum("n_bytes").over(Window.partitionBy("id").orderBy("key", "ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = aimed.filter(at_edge).withColumn("more", (F.col("before") + running - F.col("n_bytes") / 2 <= F.col("rest")).cast("int"))
    columns = ["id", "ordinal", "n_bytes", (F.col("epochs") + F.col("more")).cast("int").alias("repeats")]
    chosen = inside.select(*columns).unionByName(edge.select(*columns)).filter(F.col("repeats") > 0)

    whole = float(sum(q for q in quotas.values() if q and q > 0)) or 1.0
    reachable = float(sum(quotas[k] for k in chosen_plan)) or 1.0
    rows = [(k, sizes.get(k, 0), max(q or 0, 0) / whole, (q / reachable) if k in chosen_plan else 0.0) for k, q in quotas.items()]
    plan = spark.createDataFrame(rows, "id string, available_bytes bigint, target_share double, reachable_share double")
    got = chosen.groupBy("id").agg(F.sum(F.col("n_bytes") * F.col("repeats")).alias("b"), F.count(F.lit(1)).alias("n"), F.max("repeats").alias("m"))
    all_bytes = F.sum(F.coalesce("b", F.lit(0))).over(Window.partitionBy())  # one row per plan entry
    shares = plan.join(got, "id", "left").select(
        "id",
        "available_bytes",
        "target_share",
        "reachable_share",
        F.coalesce("b", F.lit(0)).alias("actual_bytes"),
        F.when(all_bytes > 0, F.coalesce("b", F.lit(0)) / all_bytes).otherwise(0.0).alias("actual_share"),
        F.coalesce("n", F.lit(0)).alias("records"),
        F.coalesce("m", F.lit(0)).alias("largest_repeat"),
    )
    return chosen, shares


def mix_upstream(spark: SparkSession, sf_dir: str, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Problem 4 over the whole of upstream_identity_v1."""
    table = spark.read.parquet(f"{sf_dir}/source_plan_2026_10_02.parquet")
    # 40 rows at every scale
    quotas = {r["id"]: r["q"] for r in table.groupBy("id").agg(F.min_by(F.col("quotas.normal"), "plan_idx").alias("q")).collect() if r["id"] is not None}
    plan = table.groupBy("repo", "revision", "config", "split").agg(F.min_by("id", "plan_idx").alias("id"))
    upstream = spark.read.parquet(f"{sf_dir}/upstream_identity_v1.parquet").select("source", "ordinal", F.octet_length("text").cast("bigint").alias("n_bytes"))
    known = with_plan_id(upstream, plan).filter(F.col("id").isNotNull() & (F.col("n_bytes") > 0))
    records = known.groupBy("id", "ordinal").agg(F.max("n_bytes").alias("n_bytes"))
    labels = label_fields(spark.read.parquet(f"{sf_dir}/cpt_labels.parquet"))
    weighed = records.join(labels, (F.col("id") == F.col("source_id")) & (F.col("ordinal") == F.col("row_ordinal")), "left")
    return mix(weighed.select("id", "ordinal", "n_bytes", quality_weight().alias("weight")), quotas, total)


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen records, each with its source's target and actual share."""
    chosen, shares = mix_upstream(spark, sf_dir)
    # one row per plan entry
    return chosen.join(F.broadcast(shares.select("id", "target_share", "actual_share")), "id")


def source_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every plan entry."""
    return mix_upstream(spark, sf_dir)[1]
