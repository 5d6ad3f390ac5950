"""Sinks: size-rolled JSON lines, audit manifests, metrics logs, phase manifests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import n_bytes
from millrace.operators.labels import audit
from millrace.operators.order import prefix_sum
from millrace.sources.cache import CacheError, read_json, write_json


def write_rolled_jsonl(docs: DataFrame, path: str, order: list[str], shard_bytes: int = 500 * 1024**2, text: str = "text") -> None:
    """JSON lines in folders ``shard=N`` of about ``shard_bytes``: a shard takes the documents that begin in its stretch of bytes."""
    cut = prefix_sum(docs, n_bytes(F.col(text)), order, "_before").withColumn("shard", F.floor(F.col("_before") / shard_bytes).cast("bigint")).drop("_before")
    cut.repartition("shard").sortWithinPartitions("shard", *order).write.partitionBy("shard").json(path)


def write_audit(decided: DataFrame, path: str, fingerprint: str, check=None, limited: bool = False, replace: bool = False) -> dict:
    """Decisions as Parquet and their counts as a manifest, which is written on failure too.

    An audit of another policy (fingerprint) is kept unless it is to be replaced.

    ``check(decided)`` may raise; the manifest then says so, and the error goes
    on. Only a whole pass without a limit is complete.
    """
    spark = decided.sparkSession
    stored = read_json(spark, f"{path}/manifest.json")
    if stored and stored.get("fingerprint") != fingerprint and not replace:
        raise CacheError("the audit was made under another policy")
    manifest: dict = {"version": 2, "fingerprint": fingerprint, "complete": False, "error": None}
    try:
        if check is not None:
            check(decided)
        decided.select("source_id", "ordinal", F.col("predicted_route").alias("route"), "decision", "content_hash", "split").write.mode("overwrite").parquet(f"{path}/decisions")
        counts = audit(decided).orderBy("route", "decision", "split").collect()  # routes x decisions x splits
        manifest.update(complete=not limited, verified_rows=sum(r["n"] for r in counts), decisions=[r.asDict() for r in counts])
    except Exception as e:
        manifest["error"] = f"{type(e).__name__}: {e}"[:500]
        raise
    finally:
        write_json(spark, f"{path}/manifest.json", manifest)
    return manifest


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.withColumn("timestamp", F.lit(dt.datetime.now(dt.timezone.utc).isoformat())).write.mode("append").json(path)


def phase_manifest(phase: dict, partitions: dict[str, list], catalog: dict[str, dict]) -> dict:
    """What a phase reads: the files of its partition, and its secondary sources with their catalog entries; an unknown one is an error."""
    files = partitions.get(f"phase_{phase.get('partition', phase['id'])}", [])
    sources = []
    for s in phase.get("sources", []):
        if s["dataset"] not in catalog:
            raise ValueError(f"unknown dataset {s['dataset']}")
        sources.append({**s, "catalog": catalog[s["dataset"]]})
    return {"id": phase["id"], "name": phase.get("name"), "files": files, "sources": sources, "mix": phase.get("mix")}
