"""Packing a corpus that arrives in batches.

Structured Streaming hands over micro-batches; the state between them is the
number of documents and of tokens so far, which says where the open chunk
stands. What is written are slices (which part of which document lies where in
which chunk), and chunks are put together from them and the documents. The state
is written with the batch it belongs to, so a batch that runs again starts from
the same state and writes the same files: interrupted and resumed gives what
one run gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.packing import placed, slices
from millrace.sources.cache import read_json, write_json
from millrace.storage import materialize, release


class IncrementalPacker:
    """Packs micro-batches into slices (doc key, chunk_id, skip, offset, n) under ``path``; counters follow from them."""

    def __init__(self, path: str, key: str, n_tokens: Column, source: str, order: Sequence[str], length: int, budget: int | None = None):
        self.path, self.key, self.n_tokens, self.source, self.order, self.length, self.budget = path, key, n_tokens, source, list(order), length, budget

    def state(self, spark: SparkSession, batch: int) -> dict:
        """State after the given batch; before the first, nothing."""
        return (read_json(spark, f"{self.path}/state-{batch}.json") if batch >= 0 else None) or {"documents": 0, "tokens": 0}

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before = self.state(spark, batch - 1)
        left = None if self.budget is None else max(0, self.budget - before["tokens"])
        # the batch is read once: its numbers are kept, not its texts
        sizes = materialize(rows.select(self.key, self.source, *[c for c in self.order if c not in (self.key, self.source)], self.n_tokens.cast("bigint").alias("_n")), "batch")
        done = materialize(placed(sizes, F.col("_n"), self.order, left), "placed")
        moved = done.withColumn("pre", F.col("pre") + F.lit(before["tokens"]))
        slices(moved, self.length).select(self.key, F.coalesce(F.col(self.source), F.lit("unknown")).alias("source"), "chunk_id", "skip", "offset", "n").write.mode("overwrite").parquet(f"{self.path}/slices/batch={batch}")
        sums = done.agg(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum("given"), F.lit(0)).alias("t")).first()
        write_json(spark, f"{self.path}/state-{batch}.json", {"documents": before["documents"] + sums["d"], "tokens": before["tokens"] + sums["t"]})
        release(sizes, done)

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def slices(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/slices")


def label_rates(labels: DataFrame, time: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows by window and route; on a stream, rows later than the watermark are left out."""
    return labels.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), "route").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "route", "n")
