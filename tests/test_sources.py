import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from millrace import config
from millrace.operators import labels as L
from millrace.operators import packing as P
from millrace.operators import tokenize as T
from millrace.sources import cache as C
from millrace.sources import readers as R
from millrace.sources import sinks as S

LINES = ['{"text": "valid"}', "{not-json", "", '{"other": 1}', '{"text": ""}', '{"text": 5}', "[1]", "7", '{"text": "  ğ "}']


def test_jsonl(spark, tmp_path):
    plain, packed = tmp_path / "a.jsonl", tmp_path / "b.jsonl.gz"
    plain.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    packed.write_bytes(gzip.compress("\n".join(LINES).encode()))
    paths = [str(plain), str(tmp_path / "none.jsonl"), str(packed)]
    rows = R.scan_jsonl(spark, paths)
    assert sorted(r.text for r in rows.filter("status = 'ok'").collect()) == ["  ğ ", "  ğ ", "valid", "valid"]
    c = R.jsonl_counters(rows).first()
    assert (c.total, c.valid, c.invalid_json, c.missing_field, c.empty_text) == (16, 4, 2, 6, 4)
    assert R.count_lines(spark, paths) == 18 and R.count_lines(spark, []) == 0
    assert R.scan_jsonl(spark, []).count() == 0
    first = R.jsonl_counters(R.scan_jsonl(spark, paths, max_samples=3)).first()
    assert (first.total, first.valid) == (9, 3)
    assert R.jsonl_counters(R.scan_jsonl(spark, paths, max_samples=9)).first() == c


def test_lines_are_numbered_over_splits(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}.jsonl").write_text("".join(f'{{"text": "{k * 1000 + i}"}}\n' + "\n" * (i % 3) for i in range(1000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = R.read_raw_jsonl(spark, f"{tmp_path}/*.jsonl", "s")
        assert read.rdd.getNumPartitions() > 10
        assert [(r.ordinal, r.text) for r in read.orderBy("ordinal").collect()] == [(i, str(i)) for i in range(3000)]
        assert [r.text for r in R.read_ordered_jsonl(spark, str(tmp_path)).orderBy("key").collect()] == [str(i) for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_label_files():
    listing = ["labels/b.parquet", "labels/a.parquet", "readme.md"]
    assert R.label_files(listing, "a" * 40, pattern="labels/*.parquet") == ["labels/a.parquet", "labels/b.parquet"]
    assert R.label_files(listing, "a" * 40, files=["labels/b.parquet"]) == ["labels/b.parquet"]
    for revision, more in (("main", {}), ("a" * 40, {"files": ["none"]}), ("a" * 40, {"pattern": "none*"})):
        with pytest.raises(ValueError):
            R.label_files(listing, revision, **more)


def test_raw_mirror(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"text": "a"}\n\n{"text": "b"}\n \n{"text": 7}\n', encoding="utf-8")
    got = R.read_raw_jsonl(spark, str(tmp_path / "m.jsonl"), "one").orderBy("ordinal").collect()
    assert [(r.source_id, r.ordinal, r.text) for r in got] == [("one", 0, "a"), ("one", 1, "b"), ("one", 2, None)]
    (tmp_path / "bad.jsonl").write_text('{"text": "a"}\n{oops\n')
    with pytest.raises(Exception):
        R.read_raw_jsonl(spark, str(tmp_path / "bad.jsonl"), "one").collect()


def test_raw_parquet_ordinals(spark, tmp_path):
    for k in range(3):
        spark.range(k * 100, k * 100 + 100).selectExpr("cast(id as string) as text").coalesce(1).write.parquet(str(tmp_path / f"part{k}"))
    got = R.read_raw_parquet(spark, str(tmp_path / "part*"), "one").collect()
    assert sorted(r.ordinal for r in got) == list(range(300)) and all(int(r.text) == r.ordinal for r in got)


def test_labels_and_scores(spark, tmp_path):
    row = {"source_id": "s", "row_ordinal": 1, "doc_id": "d", "document_hash": "h", "input_bytes": 2, "input_truncated": False, "predicted_label_json": "{}", "predicted_route": "KEEP"}
    (tmp_path / "l.jsonl").write_text(json.dumps(row) + "\n")
    jsonl = R.read_labels(spark, [str(tmp_path / "l.jsonl")])
    jsonl.write.parquet(str(tmp_path / "l.parquet"))
    assert jsonl.collect() == R.read_labels(spark, [str(tmp_path / "l.parquet")]).collect()
    with pytest.raises(ValueError):
        R.read_labels(spark, [])
    (tmp_path / "en" / "deep").mkdir(parents=True)
    rows = [{"text": "a", "score": 4.5}, {"text": "b", "score": "4"}, {"text": "c"}, {"text": " ", "score": 9}, {"text": "d", "score": None}]
    (tmp_path / "en" / "deep" / "x.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\nbad")
    assert sorted(r.text for r in R.read_scored_jsonl(spark, str(tmp_path / "en"), "score", 4.0).collect()) == ["a", "b"]
    assert sorted(r.text for r in R.read_scored_jsonl(spark, str(tmp_path / "en"), "score", 0.0).collect()) == ["a", "b", "c"]


def test_files_and_text(spark, tmp_path):
    for p in ("p_1/a_1.gz", "p_2/a_2.gz", "other.txt"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("xyz\n \n  q \n")
    got = sorted((r.path, r["size"]) for r in R.list_files(spark, str(tmp_path), "p_*/a_*.gz").collect())
    assert got == [("p_1/a_1.gz", 11), ("p_2/a_2.gz", 11)]
    assert [r.path for r in R.list_files(spark, str(tmp_path), "none*", "*.txt").collect()] == ["other.txt"]
    assert sorted(r.text for r in R.read_text_lines(spark, str(tmp_path / "other.txt")).collect()) == ["q", "xyz"]


def chunks(spark):
    df = spark.createDataFrame([(0, "tr", [65, 66]), (1, "en", [67]), (2, "tr", [68, 69, 70])], "k bigint, source string, ids array<int>")
    return P.pack(df, F.col("ids"), "source", ["k"], 4)


def test_cache(spark, tmp_path):
    path, identity = str(tmp_path / "cache"), {"split": "validation", "tokenizer": "t"}
    m = C.write_cache(chunks(spark), path, identity, 4, chunks_per_shard=2)
    assert (m["complete"], m["total_chunks"], m["total_tokens"], m["stored_tokens"]) == (True, 3, 9, 12)
    assert m["source_ids"] == {"tr": 1, "en": 2} and m["source_token_counts"] == {"tr": 7, "en": 2}
    assert C.write_cache(chunks(spark), path, identity, 4) == m  # used again
    assert C.read_cache(spark, path).count() == 3
    with pytest.raises(C.CacheError, match="other data"):
        C.write_cache(chunks(spark), path, {"split": "train"}, 4)
    with pytest.raises(C.CacheError, match="exists"):
        C.write_cache(chunks(spark), path, identity, 4, resume=False)
    C.require_heldout(identity, "t")
    for bad in ({"split": "train", "tokenizer": "t"}, {"split": "test", "tokenizer": "u"}):
        with pytest.raises(C.CacheError):
            C.require_heldout(bad, "t")
    columns = ["chunk_id", "tokens", "valid_length", "token_sources", "source"]
    want = [tuple(r) for r in C.read_cache(spark, path).select(*columns).orderBy("chunk_id").collect()]
    meta = C.export_flat(spark, path, str(tmp_path / "flat"), "uint16")
    assert meta["num_chunks"] == 3 and os.path.getsize(meta["tokens"]) == 3 * 4 * 2
    assert [tuple(r) for r in C.read_flat(spark, str(tmp_path / "flat")).select(*columns).orderBy("chunk_id").collect()] == want
    twice = C.import_flat(spark, [meta["tokens"], meta["tokens"]], 4, "<class 'numpy.uint16'>", source_ids=None).orderBy("chunk_id").collect()
    assert [r.chunk_id for r in twice] == list(range(6)) and [r.tokens for r in twice] == 2 * [t for _, t, *_ in want]
    unnamed = C.import_flat(spark, meta["tokens"], 4, None, source_ids=meta["source_ids"], names={1: "tr"})
    assert {r.source for r in unnamed.collect()} <= {"tr", "2"}
    (tmp_path / "cut.bin").write_bytes(b"123")
    with pytest.raises(C.CacheError, match="whole number"):
        C.import_flat(spark, str(tmp_path / "cut.bin"), 4, "uint16")
    file = next(os.path.join(d, f) for d, _, fs in os.walk(path + "/chunks") for f in fs if f.endswith(".parquet"))
    with open(file, "ab") as f:
        f.write(b"x")
    crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(C.CacheError, match="differs"):
        C.validate_cache(spark, path)
    assert C.write_cache(chunks(spark), path, {"split": "train"}, 4, rebuild=True)["complete"]


def test_flat_export_takes_many_shards_at_a_time(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, "tr" if i % 3 else "en", [i, i + 1, i + 2]) for i in range(40)], "k bigint, source string, ids array<int>")
    path = str(tmp_path / "cache")
    C.write_cache(P.pack(df, F.col("ids"), "source", ["k"], 4), path, {"split": "train"}, 4, chunks_per_shard=3)
    columns = ["chunk_id", "tokens", "valid_length", "token_sources", "source"]
    want = [tuple(r) for r in C.read_cache(spark, path).select(*columns).orderBy("chunk_id").collect()]
    for most in (1, 200, 64_000_000):
        monkeypatch.setattr(C, "FLAT_BYTES", most)
        out = str(tmp_path / f"flat{most}")
        spark.sparkContext.setJobGroup(out, out)
        C.export_flat(spark, path, out, "uint32")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(out))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [tuple(r) for r in C.read_flat(spark, out).select(*columns).orderBy("chunk_id").collect()] == want
    assert jobs < 10


def test_incomplete_cache_is_none(spark, tmp_path):
    path = str(tmp_path / "cache")
    bad = chunks(spark).withColumn("valid_length", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        C.write_cache(bad, path, {}, 4)
    with pytest.raises(C.CacheError, match="not complete"):
        C.read_cache(spark, path)
    with pytest.raises(C.CacheError, match="no cache"):
        C.validate_cache(spark, str(tmp_path / "none"))


def test_rolled_jsonl(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * 10) for i in range(10)], "k bigint, text string")
    S.write_rolled_jsonl(df, str(tmp_path / "out"), ["k"], 25)
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 10 and {r.shard: r["count"] for r in back.groupBy("shard").count().collect()} == {0: 3, 1: 2, 2: 3, 3: 2}


def test_audit(spark, tmp_path):
    df = spark.createDataFrame([("s", 0, "KEEP", "accepted", "h", "train")], "source_id string, ordinal bigint, predicted_route string, decision string, content_hash string, split string")
    m = S.write_audit(df, str(tmp_path / "a"), "f")
    assert m["complete"] and m["verified_rows"] == 1 and not S.write_audit(df, str(tmp_path / "a"), "f", limited=True)["complete"]

    def check(_):
        raise L.IntegrityError("hash differs at s:0")

    with pytest.raises(L.IntegrityError):
        S.write_audit(df, str(tmp_path / "a"), "f", check=check)
    m = C.read_json(spark, str(tmp_path / "a" / "manifest.json"))
    assert not m["complete"] and "hash differs" in m["error"]


def test_metrics_and_phases(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "step int, loss double")
    S.append_metrics(df, str(tmp_path / "m"))
    S.append_metrics(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
    phase = {"id": 2, "partition": 1, "sources": [{"dataset": "d"}]}
    assert S.phase_manifest(phase, {"phase_1": ["f"]}, {"d": {"path": "p"}})["files"] == ["f"]
    assert S.phase_manifest({"id": 3}, {}, {})["files"] == []
    with pytest.raises(ValueError):
        S.phase_manifest(phase, {}, {})


def letters():
    class Letters:
        """A tokenizer of code points up to 255."""

        eos_token_id, pad_token_id, vocab_size = None, 0, 256

        def encode(self, text, add_special_tokens=False):
            return [ord(c) for c in text]

    return Letters()


def test_tokenizer(spark):
    assert T.special_ids(letters()) == (0, 0) and T.id_type(65_536) == "uint16" and T.id_type(65_537) == "uint32"
    assert T.fingerprint(letters()) == T.fingerprint(letters())
    df = spark.createDataFrame([("ab", 1), ("", 2), (None, 3)], "text string, k int")
    assert [r.tokens for r in T.encode(df, "text", letters()).orderBy("k").collect()] == [[97, 98], [], []]
    with pytest.raises(Exception, match="outside the vocabulary"):
        T.encode(spark.createDataFrame([("ş",)], "text string"), "text", letters()).collect()


def test_file_tokenizers(spark):
    folder = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")
    if not os.path.exists(f"{folder}/byte_bpe_50k.tiktoken"):
        pytest.skip("no vocabulary files")
    ranks, whole = T.FileTokenizer(f"{folder}/byte_bpe_50k.tiktoken", 50256), T.FileTokenizer(f"{folder}/byte_bpe_50k.json")
    texts = ["Selam dünya, it's <|endoftext|> 12", "x"]
    assert ranks.encode_batch(texts) == whole.encode_batch(texts) == [ranks.encode(t) for t in texts]
    assert len(ranks) == len(whole) == 50257 and len(T.FileTokenizer(f"{folder}/piece_bpe_32k.model")) == 32000
    df = spark.createDataFrame([(texts[0],), (None,), ("",)], "text string")
    assert sorted(r.tokens for r in T.encode(df, "text", ranks).collect()) == [[], [], ranks.encode(texts[0])]
    assert T.fingerprint(ranks) != T.fingerprint(whole)
    base = whole.settings()
    assert T.changed_settings(base, json.loads(json.dumps(base))) == []
    more = json.loads(json.dumps(base))
    more["model"]["merges"] = more["model"]["merges"][1:]
    more["normalizer"] = {"type": "NFC"}
    more["added_tokens"] = []
    assert T.changed_settings(base, more) == ["normalizer", "merges", "added token <|endoftext|>"]
    assert T.legacy_special_ids(letters()) == (0, 0)
    with pytest.raises(ValueError):
        T.FileTokenizer("x.txt").encode("a")


def test_appended_vocabulary(spark):
    def vocab(*tokens):
        return spark.createDataFrame(list(tokens), "token string, id bigint")

    base = vocab(("a", 0), ("b", 1))
    assert T.appended_only(base, vocab(("a", 0), ("b", 1), ("c", 2))).collect() == []
    assert {r.violation for r in T.appended_only(base, vocab(("a", 0))).collect()} == {"lost_or_moved"}
    assert "outside_block" in {r.violation for r in T.appended_only(base, vocab(("a", 0), ("b", 1), ("c", 9))).collect()}
    assert "repeated_id" in {r.violation for r in T.appended_only(base, vocab(("a", 0), ("b", 1), ("c", 1))).collect()}


def test_config(tmp_path):
    file = tmp_path / "c.json"
    file.write_text(json.dumps({"phases": [{"id": 1, "max_tokens": 5}], "paths": {"data_dir": "x"}}))
    c = config.load(str(file), {"DATA_DIR": str(tmp_path / "d"), "CACHE_DIR": ""})
    assert c["paths"] == {"data_dir": str(tmp_path / "d")} and config.phase(c, 1)["max_tokens"] == 5
    c["labels_revision"], c["secondary"] = "a" * 40, [{"name": "web", "path": "x", "revision": "b" * 40}]
    config.require_runnable(c, str(tmp_path))
    assert config.load(str(file), {"CPT_RESUME": "last"})["checkpointing"] == {"resume_from": "last"}
    again = config.frozen({**c, "secondary": [{"name": "web"}]}, {"labels": "c" * 40, "web": "d" * 40})
    assert again["labels_revision"] == "c" * 40 and again["secondary"][0]["revision"] == "d" * 40
    config.dump(c, str(tmp_path / "out.yaml"))
    assert config.load(str(tmp_path / "out.yaml"), {}) == c
    assert config.only({"a": {}, "b": {}}, "b") == {"b": {}} and len(config.only({"a": {}, "b": {}}, None)) == 2
    for f in (lambda: config.only({}, "x"), lambda: config.frozen(c, {"labels": "main"}), lambda: config.require_same_signature({"data": 1}, {"data": 2})):
        with pytest.raises(ValueError):
            f()
    with pytest.raises(ValueError):
        config.phase(c, 2)
    for wrong in ({**c, "phases": []}, {**c, "paths": {"data_dir": "/etc"}}, {**c, "phases": [{"id": 1}]}, {**c, "labels_revision": "main"}, {**c, "secondary": [{"name": "web"}]}):
        with pytest.raises(ValueError):
            config.require_runnable(wrong, str(tmp_path))
    assert config.cache_name(2) == "phase_2" and config.cache_name(2, "test") == "phase_2_test"
    assert config.fingerprint({"a": 1, "b": 2}) == config.fingerprint({"b": 2, "a": 1}) != config.fingerprint({})
