import json
import os

import pytest
from test_labels import LABEL, ROWS, plan, raw_world
from pyspark.sql import functions as F

from millrace import cli
from millrace.operators import labels as L
from millrace.plans import pipeline as P
from millrace.sources import cache as C
from millrace.sources import phases


def inputs(spark, rows):
    raw, labels = raw_world(spark, rows)
    return raw, plan(spark), labels


def secondary(spark, texts, **more):
    rows = [(k, t, s) for k, (t, s) in enumerate(texts)]
    return P.Secondary("web", spark.createDataFrame(rows, "key bigint, text string, score string"), **more)


def test_decisions_in_turn(spark):
    got = P.decided_rows(*inputs(spark, ROWS), P.Rules()).orderBy("pos").collect()
    assert [(r.source_id, r.ordinal) for r in got] == [("one", 0), ("two", 0), ("one", 2), ("two", 1), ("one", 5), ("two", 2), ("two", 9)]
    upstream, p, _ = inputs(spark, ROWS)
    texts = P.accepted_texts(P.decided_rows(*inputs(spark, ROWS), P.Rules()), "all", L.raw_texts(upstream.unionAll(upstream), p))
    assert [(r.key, r.text) for r in texts.orderBy("key").collect()] == [(0, "selam"), (4, "yine")]


def test_missing_row_stops(spark):
    upstream, p, labels = inputs(spark, ROWS)
    with pytest.raises(L.IntegrityError, match="no raw row at two:9"):
        P.decided_rows(upstream.filter("ordinal < 9"), p, labels, P.Rules())


def test_secondary(spark):
    texts = [("aaaa", "5"), ("bbbb", "1"), ("cccc", None), (" ", "9"), ("dddd", "4"), ("eeee", "7")]
    source = secondary(spark, texts, score_gte=4.0, target_gb=8.5 / 1024**3)
    assert [r.text for r in P.secondary_texts(source, P.Rules(split="all")).orderBy("key").collect()] == ["aaaa", "dddd"]
    a, b = P.secondary_texts(source, P.Rules(split="train", fraction=0.5)), P.secondary_texts(source, P.Rules(split="validation", fraction=0.5))
    assert {r.text for r in a.union(b).collect()} <= {"aaaa", "dddd", "eeee"}


def test_secondary_counters(spark):
    texts = [("aaaa", "5"), ("bbbb", "1"), ("cccc", None), (" ", "9"), ("dddd", "4"), ("eeee", "7")]
    row = P.secondary_counters(secondary(spark, texts, score_gte=4.0, target_gb=8.5 / 1024**3), P.Rules(split="all")).first().asDict()
    assert row == {"source": "web", "n_rows": 6, "low_score": 2, "blank": 1, "other_split": 0, "over_budget": 1, "accepted": 2, "accepted_bytes": 8}


@pytest.mark.parametrize("unit", ["tokens", "texts"])
def test_mixing(spark, unit):
    primary = spark.createDataFrame([(k, "t" * 99) for k in range(60)], "key bigint, text string")
    others = [(spark.createDataFrame([(k, c * 9) for k in range(400)], "key bigint, text string"), w) for c, w in (("e", 1.0), ("f", 3.0))]
    rows = P.mixed_tokens(primary, others, cli.CodePoints(), P.Rules(unit=unit, least_chars=5)).orderBy("pos").collect()
    tokens = {s: sum(len(r.tokens) + 1 for r in rows if r.source == s) for s in ("primary", "secondary")}
    if unit == "tokens":
        assert abs(tokens["primary"] / sum(tokens.values()) - 0.8) < 0.02
        e, f = (sum(len(r.tokens) for r in rows if r.tokens[0] == ord(c)) for c in "ef")
        assert abs(f / (e + f) - 0.75) < 0.05
    else:
        assert len(rows) == 860
        with pytest.raises(ValueError):
            P.mixed_tokens(primary, others, cli.CodePoints(), P.Rules(primary_ratio=1.0))


def test_cache_by_command(spark, tmp_path, capsys):
    upstream, p, labels = inputs(spark, [("one", i, f"metin {i} " * 5, "KEEP", False) for i in range(30)])
    for name, df in (("u", upstream), ("p", p), ("l", labels)):
        df.write.parquet(str(tmp_path / name))
    (tmp_path / "en").mkdir()
    (tmp_path / "en" / "a.jsonl").write_text("\n".join(json.dumps({"text": f"text {i} " * 3, "score": 5}) for i in range(30)) + "\nbad\n")
    config = {
        "tables": {"upstream": str(tmp_path / "u"), "plan": str(tmp_path / "p"), "labels": str(tmp_path / "l")},
        "secondary": [{"name": "web", "path": str(tmp_path / "en"), "score_gte": 4}],
        "rules": {"split": "train", "length": 64, "max_tokens": 500, "fraction": 0.2},
        "phases": [{"id": 1}],
        "paths": {"cache_dir": str(tmp_path / "cache"), "manifest_dir": str(tmp_path / "m")},
    }
    file = tmp_path / "c.json"
    file.write_text(json.dumps(config))
    for command in ("dry-run", "plan", "validate", "validate-datasets", "prepare-token-cache", "prepare-token-cache"):
        assert cli.main([command, "--config", str(file)], spark=spark) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert said[-1] == said[-2] and said[-1]["complete"] and said[-1]["total_tokens"] == 500 and said[-1]["total_chunks"] == 8
    counts = said[-1]["source_token_counts"]
    assert sum(counts.values()) == 500 and abs(counts["primary"] / 500 - 0.8) < 0.15
    assert os.path.exists(tmp_path / "m" / "phase_1_manifest.json")
    audit = C.read_json(spark, str(tmp_path / "cache" / "audit" / "manifest.json"))
    assert audit["complete"] and audit["verified_rows"] == 30
    assert C.read_cache(spark, str(tmp_path / "cache" / "phase_1")).count() == 8
    with pytest.raises(SystemExit):
        cli.main(["else", "--config", str(file)])
    # other labels, other secondary files: no stale cache
    labels.withColumn("predicted_route", F.lit("PREMIUM")).write.mode("overwrite").parquet(str(tmp_path / "l"))
    with pytest.raises(C.CacheError, match="other data"):
        cli.main(["prepare-token-cache", "--config", str(file)], spark=spark)
    assert C.read_json(spark, str(tmp_path / "cache" / "audit" / "manifest.json"))["fingerprint"] == audit["fingerprint"]
    assert cli.main(["prepare-token-cache", "--config", str(file), "--rebuild"], spark=spark) == 0
    with open(tmp_path / "en" / "a.jsonl", "a") as f:
        f.write(json.dumps({"text": "more", "score": 5}) + "\n")
    with pytest.raises(C.CacheError, match="other data"):
        cli.main(["prepare-token-cache", "--config", str(file)], spark=spark)


def test_phase_folders(tmp_path):
    shards = []
    for i in range(8):
        f = tmp_path / "in" / f"p{i % 2}" / f"a{i // 2}.gz"
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("x" * (i + 1))
        shards.append((str(f), i + 1))
    out = str(tmp_path / "out")
    assert phases.deal_files(shards, out, 3, dry_run=True) and not os.path.exists(out)
    for copy in (False, True):
        manifests = phases.deal_files(shards, out, 3, copy=copy)
        assert sorted(p for m in manifests for p in m["files"]) == sorted(p for p, _ in shards) and sum(m["bytes"] for m in manifests) == 36
        files = [os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs if f.endswith(".gz")]
        assert len(files) == 8 and all(os.path.islink(f) != copy for f in files)


def test_checkpoints(tmp_path):
    assert phases.newest_checkpoint(str(tmp_path / "none")) is None
    for k, name in enumerate(("a", "b", "c")):
        (tmp_path / name).mkdir()
        if name != "c":
            (tmp_path / name / "training_state.pt").write_text("x")
        os.utime(tmp_path / name, (k, k))
    assert phases.newest_checkpoint(str(tmp_path)).endswith("b")
    phases.put_json(str(tmp_path / "latest.json"), {"path": "a"})
    assert phases.newest_checkpoint(str(tmp_path)).endswith("a")
    phases.put_json(str(tmp_path / "latest.json"), {"path": "c"})
    assert phases.newest_checkpoint(str(tmp_path)).endswith("b")
    assert phases.expired_checkpoints(["a", "b", "c"], 2) == ["a"] and phases.expired_checkpoints(["a"], 0) == []
    assert phases.download_done(96 * 1024**3 // 100, 1.0) and not phases.download_done(94 * 1024**3 // 100, 1.0)


def test_labels_schema_is_known():
    assert LABEL.count(",") == 7


def test_command_with_a_tokenizer_file_and_frozen_inputs(spark, tmp_path):
    tokenizer = f"{os.environ.get('MILLRACE_TOKENIZERS', '/opt/tokenizers')}/byte_bpe_50k.tiktoken"
    if not os.path.exists(tokenizer):
        pytest.skip("no vocabulary files")
    upstream, p, labels = inputs(spark, [("one", i, f"metin {i} " * 5, "KEEP", False) for i in range(20)])
    for name, df in (("u", upstream), ("p", p), ("l", labels)):
        df.write.parquet(str(tmp_path / name))
    (tmp_path / "l" / "REVISION").write_text("c" * 40 + "\n")
    config = {
        "tables": {"upstream": str(tmp_path / "u"), "plan": str(tmp_path / "p"), "labels": str(tmp_path / "l")},
        "tokenizer": {"path": tokenizer, "eos_token_id": 50256},
        "rules": {"length": 32},
        "phases": [{"id": 1, "max_tokens": 10**6}],
        "paths": {"cache_dir": str(tmp_path / "cache"), "manifest_dir": str(tmp_path / "m")},
        "storage_root": str(tmp_path),
    }
    file, frozen = tmp_path / "c.json", tmp_path / "frozen.json"
    file.write_text(json.dumps(config))
    with pytest.raises(ValueError, match="freeze"):
        cli.main(["dry-run", "--config", str(file)])
    os.remove(tmp_path / "l" / "REVISION")
    with pytest.raises(OSError):
        cli.main(["freeze-inputs", "--config", str(file), "--output", str(frozen)])
    (tmp_path / "l" / "REVISION").write_text("c" * 40 + "\n")
    assert cli.main(["freeze-inputs", "--config", str(file), "--output", str(frozen)]) == 0
    os.rename(tmp_path / "l" / "REVISION", tmp_path / "l" / "_REVISION")
    assert cli.main(["prepare-token-cache", "--config", str(frozen), "--split", "all"], spark=spark) == 0
    chunks = C.read_cache(spark, str(tmp_path / "cache" / "phase_1_all"))
    from millrace.operators.tokenize import FileTokenizer

    want = [FileTokenizer(tokenizer).encode(f"metin {i} " * 5) + [50256] for i in range(20)]
    got = [t for r in chunks.orderBy("chunk_id").collect() for t in r.tokens[: r.valid_length]]
    assert got == sum(want, [])
    with pytest.raises(ValueError, match="no accepted"):
        labels.withColumn("predicted_route", F.lit("DROP")).write.mode("overwrite").parquet(str(tmp_path / "l"))
        cli.main(["validate-datasets", "--config", str(frozen), "--max-documents", "3"], spark=spark)
