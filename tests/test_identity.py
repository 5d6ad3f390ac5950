import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import identity as I


def test_bounds():
    assert I.split_bound(0.01) == "028f5c28f5c28f60" + "0" * 48
    assert I.split_bound(0.3) == "4ccccccccccccc00" + "0" * 48
    assert I.split_bound(1) == "f" * 64


@pytest.mark.parametrize("fraction", [0.01, 0.3])
def test_split_is_the_integer_test(spark, fraction):
    hashes = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(2000)]
    got = {r.h: r.s for r in spark.createDataFrame([(h,) for h in hashes], "h string").select("h", I.content_split(F.col("h"), fraction, 42).alias("s")).collect()}
    for h in hashes:
        small = int(hashlib.sha256(f"42:{h}".encode()).hexdigest(), 16) < int(fraction * (1 << 256))
        assert got[h] == ("validation" if small else "train")


def test_document_id(spark):
    rows = [("a/b", "r" * 40, 'c"\\', "train", 48125000, "ğ\n😀"), ("a", "b", "c", "d", 0, ""), ("a", "b", "c", "d", 1, None), (None, "b", "c", "d", 1, "x")]
    got = [r.i for r in spark.createDataFrame(rows, "repo string, rev string, cfg string, split string, o bigint, t string").select(I.document_id(*map(F.col, ("repo", "rev", "cfg", "split", "o", "t"))).alias("i")).collect()]

    def own(repo, rev, cfg, split, o, t):
        listed = json.dumps([repo, rev, cfg, split, o, hashlib.sha256(t.encode()).hexdigest()], ensure_ascii=False, separators=(",", ":"))
        return "doc_" + hashlib.sha256(listed.encode()).hexdigest()

    assert got == [own(*rows[0]), own(*rows[1]), None, None]


def test_identities_of_the_table(spark, tiny):
    u = spark.read.parquet(f"{tiny}/upstream_identity_v1.parquet")
    own = I.document_id(*[F.col(f"source.{c}") for c in ("repo", "revision", "config", "split")], F.col("ordinal"), F.col("text"))
    n, same = u.filter("text is not null").agg(F.count(F.lit(1)), F.count_if(own == F.col("doc_id"))).first()
    assert same > 0.9 * n


def test_revision(spark):
    rows = spark.createDataFrame([("a" * 40,), ("A" * 40,), ("a" * 39,), ("a" * 40 + "\n",), (None,)], "r string")
    assert [r[0] for r in rows.select(I.is_revision(F.col("r"))).collect()] == [True, False, False, False, False]
