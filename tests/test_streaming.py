import pytest
from pyspark.sql import functions as F

from millrace.operators import packing as P
from millrace.streaming.incremental import IncrementalPacker, label_rates

SCHEMA = "k bigint, source string, n bigint"


@pytest.mark.parametrize("budget", [None, 31])
def test_batches_pack_like_one_run(spark, tmp_path, budget):
    rows = [(i, "ab"[i % 2], i % 6) for i in range(24)]
    whole = spark.createDataFrame(rows, SCHEMA)
    want = sorted((r.k, r.chunk_id, r.skip, r.offset, r.n) for r in P.slices(P.placed(whole, F.col("n"), ["k"], budget), 8).collect())
    packer = IncrementalPacker(str(tmp_path / "out"), "k", F.col("n"), "source", ["k"], 8, budget)
    feed = str(tmp_path / "in")
    for part in (rows[:10], rows[10:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(SCHEMA).parquet(feed)
        packer.start(stream, str(tmp_path / "checkpoint")).awaitTermination(60)
    got = packer.slices(spark)
    assert sorted((r.k, r.chunk_id, r.skip, r.offset, r.n) for r in got.collect()) == want
    assert packer.state(spark, 1)["tokens"] == sum(w[4] for w in want)
    packer(spark.createDataFrame(rows[10:], SCHEMA), 1)  # a batch that runs again
    assert sorted((r.k, r.chunk_id, r.skip, r.offset, r.n) for r in packer.slices(spark).collect()) == want


def test_label_rates(spark):
    rows = spark.createDataFrame([("2026-09-01 01:00:00", "KEEP"), ("2026-09-01 23:00:00", "KEEP"), ("2026-09-02 00:00:00", None)], "t string, route string").withColumn("t", F.to_timestamp("t"))
    assert sorted((str(r.start)[:10], r.route or "", r.n) for r in label_rates(rows, "t").collect()) == [("2026-09-01", "KEEP", 2), ("2026-09-02", "", 1)]
