import hashlib
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import identity
from millrace.operators import labels as L

PLAN = "plan_idx int, id string, repo string, revision string, config string, split string, text_field string, license string"
RAW = "source struct<repo: string, revision: string, config: string, split: string>, ordinal bigint, text string"
LABEL = "source_id string, row_ordinal bigint, doc_id string, document_hash string, input_bytes bigint, input_truncated boolean, predicted_label_json string, predicted_route string"


def plan(spark):
    return spark.createDataFrame([(i, s, f"r/{s}", c * 40, "c", "train", "text", "x") for i, (s, c) in enumerate([("one", "a"), ("two", "b")])], PLAN)


def raw_world(spark, rows):
    """rows: (source, ordinal, text, route, truncated)."""
    where = {"one": ("r/one", "a" * 40, "c", "train"), "two": ("r/two", "b" * 40, "c", "train")}
    raw = spark.createDataFrame([(where[s], o, t) for s, o, t, *_ in rows], RAW)
    ids = raw.select("source", "ordinal", "text", identity.document_id(*[F.col(f"source.{c}") for c in ("repo", "revision", "config", "split")], F.col("ordinal"), F.col("text")).alias("i")).collect()
    known = {(r.source.repo, r.ordinal): r.i for r in ids}
    made = [(s, o, known[where[s][0], o], hashlib.sha256(t.encode()).hexdigest(), len(t.encode()), cut, '{"type": "x"}', route) for s, o, t, route, cut in reversed(rows)]
    return raw, spark.createDataFrame(made, LABEL)


def world(spark, rows):
    raw, labels = raw_world(spark, rows)
    return L.raw_rows(raw, plan(spark)), labels


ROWS = [
    ("one", 0, "selam", "PREMIUM", False), ("one", 2, "eksik", "MODEL_REPAIR", False), ("one", 5, "yine", "KEEP", False),
    ("two", 0, "selam", "KEEP", False), ("two", 1, "bak", "REVIEW", False), ("two", 2, "bozuk", "DROP", False), ("two", 9, "yarim", "KEEP", True),
]


def decided(spark, rows, **more):
    raw, labels = world(spark, rows)
    joined = L.join_labels(raw, labels)
    L.require_identity(joined)
    return L.decide(joined.withColumn("pos", F.col("ordinal") * 2 + F.col("plan_idx")), ["pos"], **more)


def test_decisions(spark):
    got = {(r.source_id, r.ordinal): r.decision for r in decided(spark, ROWS).collect()}
    assert got == {
        ("one", 0): "accepted", ("one", 2): "excluded_route", ("one", 5): "accepted", ("two", 0): "duplicate",
        ("two", 1): "excluded_route", ("two", 2): "excluded_route", ("two", 9): "truncated_input_review",
    }
    gated = {(r.source_id, r.ordinal): r.decision for r in decided(spark, ROWS, gated=["one"]).collect()}
    assert gated["one", 0] == "review_gate" and gated["two", 0] == "accepted"
    assert sum(r.n for r in L.audit(decided(spark, ROWS)).collect()) == len(ROWS)
    assert L.seen_index(decided(spark, ROWS)).count() == 2
    with pytest.raises(ValueError):
        decided(spark, ROWS, accepted=["DROP"])


def test_splits_are_disjoint_and_whole(spark):
    rows = [("one", i, f"metin {i}", "KEEP", False) for i in range(80)]
    d = decided(spark, rows, fraction=0.3)
    a, b = d.filter("split = 'train'").select("content_hash"), d.filter("split = 'validation'").select("content_hash")
    assert a.intersect(b).count() == 0 and a.count() + b.count() == 80 and b.count() > 5


@pytest.mark.parametrize("column,value,found", [("document_hash", "0" * 64, "hash"), ("doc_id", "doc_x", "doc_id"), ("input_bytes", 1, "bytes")])
def test_identity_fails_closed(spark, column, value, found):
    raw, labels = world(spark, ROWS)
    wrong = labels.withColumn(column, F.when(F.col("row_ordinal") == 5, F.lit(value)).otherwise(F.col(column)))
    with pytest.raises(L.IntegrityError, match=f"{found} differs at one:5"):
        L.require_identity(L.join_labels(raw, wrong))


def test_blank_text_and_missing_rows(spark):
    raw, labels = world(spark, ROWS)
    for text, found in (("", "text"), (None, "text"), (" \n", None)):
        rows, wrong = raw_world(spark, [("one", 5, text or " \n", "KEEP", False)])
        changed = L.raw_rows(rows.withColumn("text", F.lit(text)), plan(spark))
        assert {r.violation for r in L.join_labels(changed, wrong).collect()} == {found}  # white space is a text
    gone = raw.filter("ordinal < 9")
    assert [(r.source_id, r.row_ordinal) for r in L.missing_rows(gone, labels).collect()] == [("two", 9)]
    assert L.unlabelled_rows(raw, labels.filter("row_ordinal > 0")).count() == 2


def test_label_rules(spark):
    _, labels = world(spark, ROWS[:1])
    L.require_valid_labels(labels, ["one", "two"])
    cases = {
        "unknown_source": ("source_id", F.lit("else")), "bad_ordinal": ("row_ordinal", F.lit(-1).cast("bigint")), "unknown_route": ("predicted_route", F.lit("OTHER")),
        "missing_identity": ("doc_id", F.lit(None).cast("string")), "bad_truncated": ("input_truncated", F.lit(None).cast("boolean")), "bad_bytes": ("input_bytes", F.lit(None).cast("bigint")), "bad_label": ("predicted_label_json", F.lit("[1]")),
    }
    for rule, (column, value) in cases.items():
        with pytest.raises(L.IntegrityError, match=rule):
            L.require_valid_labels(labels.withColumn(column, value), ["one", "two"])
    with pytest.raises(L.IntegrityError, match="repeated"):
        L.require_valid_labels(labels.unionAll(labels), ["one"])
    with pytest.raises(L.IntegrityError, match="no labels"):
        L.require_valid_labels(labels.limit(0), ["one"])
    with pytest.raises(L.IntegrityError, match="more than"):
        L.require_valid_labels(labels, ["one"], most=0)


def test_plan_rules(spark):
    L.require_plan(plan(spark))
    for change, said in [(("license", F.lit("")), "lacks license"), (("revision", F.lit("main")), "pinned"), (("id", F.lit("one")), "twice")]:
        with pytest.raises(L.IntegrityError, match=said):
            L.require_plan(plan(spark).withColumn(*change))


def test_first_copies_among_eligible(spark):
    df = spark.createDataFrame([(0, "h", False), (1, "h", True), (2, "h", True), (3, None, True), (4, "g", None)], "pos bigint, k string, ok boolean")
    got = {r.pos: r.is_first for r in L.first_copies(df, "k", ["pos"], F.coalesce("ok", F.lit(False))).collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: False}


def test_texts_are_not_shuffled(spark, tmp_path):
    raw, labels = raw_world(spark, ROWS)
    raw.write.parquet(f"{tmp_path}/raw")
    rows = L.raw_rows(spark.read.parquet(f"{tmp_path}/raw"), plan(spark))
    plans = [L.join_labels(rows, labels), L.missing_rows(L.raw_keys(spark.read.parquet(f"{tmp_path}/raw"), plan(spark)), labels), L.unlabelled_rows(rows, labels)]
    for df in plans:
        shown = df._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in shown.splitlines() if "Exchange" in line and re.search(r"[ (,]text#", line)]
