"""The token cache: packed chunks as Parquet shards with a manifest, its checks, and flat arrays out and in.

The manifest is written last, so a cache without a complete one is no cache. A
cache is used again only for the same data, tokenizer and budget: its identity
holds digests of what it was made from.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.packing import shard_of

FORMAT = "millrace_token_cache_v2"
SOURCES = 255


class CacheError(ValueError):
    """A cache can't be used as it is."""


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write beside the place and rename, so that a reader sees the old or the new file."""
    fs, p = _file(spark, path)
    temp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(temp, True)
    out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=1, sort_keys=True).encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(temp, p):
        raise CacheError(f"{path} can't be put in its place")


def read_json(spark: SparkSession, path: str) -> dict | None:
    fs, p = _file(spark, path)
    if not fs.exists(p):
        return None
    rows = spark.read.text(path, wholetext=True).collect()  # one small file
    return json.loads(rows[0]["value"]) if rows else None


def content_digest(df: DataFrame) -> str:
    """SHA-256 of the number of rows and of sums over their hashes; the same for the same rows in any order."""
    columns = df.columns
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(1), *columns))).first()
    return hashlib.sha256(json.dumps([df.schema.simpleString(), *map(str, row)]).encode()).hexdigest()


def input_digest(df: DataFrame) -> str:
    """SHA-256 of the names, sizes and times of the files behind a DataFrame; of its content if it isn't read from files."""
    names = sorted(df.inputFiles())
    if not names:
        return content_digest(df)
    files = []
    for name in names:
        fs, p = _file(df.sparkSession, name)
        status = fs.getFileStatus(p)
        files.append([name, status.getLen(), status.getModificationTime()])
    return hashlib.sha256(json.dumps(files).encode()).hexdigest()


def token_counts(chunks: DataFrame) -> list[tuple[str, int, int]]:
    """(source, number, tokens): sources numbered from 1 in the order of their first token; more than 255 are an error. One row per source."""
    each = chunks.select("chunk_id", "token_sources", F.explode(F.array_distinct(F.filter("token_sources", lambda s: s.isNotNull()))).alias("source"))
    n = F.size(F.filter("token_sources", lambda s: s == F.col("source")))
    first = F.struct("chunk_id", F.array_position("token_sources", F.col("source")).alias("at"))
    rows = each.groupBy("source").agg(F.sum(n).alias("n"), F.min(first).alias("f")).orderBy("f").limit(SOURCES + 1).collect()
    if len(rows) > SOURCES:
        raise CacheError(f"more than {SOURCES} sources")
    return [(r["source"], i + 1, r["n"]) for i, r in enumerate(rows)]


def known_cache(spark: SparkSession, path: str, identity: dict, length: int, resume: bool = True) -> dict | None:
    """The manifest of a complete cache of this identity, checked; None where there is none or an unfinished one, and an error for another."""
    known = read_json(spark, f"{path}/manifest.json")
    if not known:
        return None
    if not resume:
        raise CacheError("a cache exists")
    if known.get("identity") != identity or known.get("seq_len") != length:
        raise CacheError("the cache was made for other data, tokenizer or budget")
    if not known.get("complete"):
        return None
    validate_cache(spark, path)
    return known


def write_cache(chunks: DataFrame, path: str, identity: dict, length: int, chunks_per_shard: int = 10_000, resume: bool = True, rebuild: bool = False) -> dict:
    """Write packed chunks (see packing.pack) and their manifest; a complete cache of the same identity is left as it is.

    Returns the manifest.
    """
    spark = chunks.sparkSession
    known = None if rebuild else known_cache(spark, path, identity, length, resume)
    if known:
        return known
    manifest = {"format": FORMAT, "complete": False, "identity": identity, "seq_len": length}
    fs, p = _file(spark, path)
    fs.delete(p, True)
    write_json(spark, f"{path}/manifest.json", manifest)
    sharded = chunks.withColumn("shard", shard_of(F.col("chunk_id"), chunks_per_shard))
    sharded.repartition("shard").sortWithinPartitions("shard", "chunk_id").write.partitionBy("shard").parquet(f"{path}/chunks")
    stored = spark.read.parquet(f"{path}/chunks")
    counts = token_counts(stored)
    majority = {r["source"]: r["n"] for r in stored.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("valid_length"), F.lit(0)).alias("t")).first()
    manifest.update(
        complete=True,
        total_chunks=total["n"],
        total_tokens=total["t"],
        stored_tokens=total["n"] * length,
        source_ids={s: i for s, i, _ in counts},
        source_chunk_counts=majority,
        source_token_counts={s: n for s, _, n in counts},
        shards=_digests(spark, path),
    )
    write_json(spark, f"{path}/manifest.json", manifest)
    return manifest


def _digests(spark: SparkSession, path: str) -> dict[str, list]:
    """Size and SHA-256 of every data file; one row per file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{path}/chunks")
    rows = files.select(F.regexp_extract("path", r"chunks/(.*)\z", 1).alias("name"), "length", F.sha2("content", 256).alias("sha")).collect()
    return {r["name"]: [r["length"], r["sha"]] for r in rows}


def validate_cache(spark: SparkSession, path: str) -> dict:
    """The manifest, if the cache is complete and every file has its size and digest."""
    manifest = read_json(spark, f"{path}/manifest.json")
    if not manifest or manifest.get("format") != FORMAT:
        raise CacheError("no cache of this format")
    if not manifest.get("complete"):
        raise CacheError("the cache is not complete")
    if _digests(spark, path) != manifest["shards"]:
        raise CacheError("a shard differs from the manifest")
    return manifest


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of a valid cache, by chunk_id."""
    validate_cache(spark, path)
    return spark.read.parquet(f"{path}/chunks")


def require_heldout(identity: dict, tokenizer_fingerprint: str) -> None:
    """An evaluation may only use a cache of a held-out split, made with the same tokenizer."""
    if identity.get("split") not in ("validation", "val", "test", "heldout"):
        raise CacheError("not a held-out split")
    if identity.get("tokenizer") != tokenizer_fingerprint:
        raise CacheError("made with another tokenizer")


def _encoded(chunks: DataFrame, sources: dict[str, int], dtype: str) -> DataFrame:
    """Runs of consecutive chunks as flat little-endian arrays: tokens, majority and token source ids, valid lengths."""

    def run(it):
        import numpy as np
        import pyarrow as pa

        for batch in it:
            batch = batch.sort_by("chunk_id")
            ids = batch.column("chunk_id").to_numpy()
            tokens, of = batch.column("tokens"), batch.column("token_sources").flatten().dictionary_encode()
            each = len(tokens.flatten()) // max(len(ids), 1)
            codes = np.array([*(sources[s] for s in of.dictionary.to_pylist()), 0], np.uint8)
            arrays = [
                tokens.flatten().to_numpy(zero_copy_only=False).astype(np.dtype(dtype).newbyteorder("<")).reshape(-1, each),
                np.array([sources[s] for s in batch.column("source").to_pylist()], np.uint8),
                codes[of.indices.fill_null(len(codes) - 1).to_numpy(zero_copy_only=False)].reshape(-1, each),
                batch.column("valid_length").to_numpy().astype("<u4"),
            ]
            cuts = [0, *(np.flatnonzero(np.diff(ids) != 1) + 1).tolist(), len(ids)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi > lo:
                    yield pa.RecordBatch.from_arrays([pa.array([int(ids[lo])]), *(pa.array([x[lo:hi].tobytes()], pa.binary()) for x in arrays)], ["first", *FLAT])

    columns = chunks.select(F.col("chunk_id").cast("bigint"), "tokens", "source", "token_sources", "valid_length")
    return columns.mapInArrow(run, "first bigint, " + ", ".join(f"{k} binary" for k in FLAT))


FLAT = {"tokens": "packed_tokens.bin", "source_ids": "source_ids.bin", "token_sources": "token_source_ids.bin", "valid_lengths": "valid_lengths.bin"}


#: Bytes of flat arrays that the driver holds at a time, about; a shard is held whole.
FLAT_BYTES = 64_000_000


def export_flat(spark: SparkSession, path: str, out: str, dtype: str) -> dict:
    """A valid cache as four flat files and their metadata below ``out``, in the order of chunks; encoded by all executors, many shards at a time. Returns the metadata."""
    import numpy as np

    manifest = validate_cache(spark, path)
    chunks = spark.read.parquet(f"{path}/chunks")
    streams = {}
    for key, name in FLAT.items():
        fs, p = _file(spark, f"{out}/{name}")
        fs.mkdirs(p.getParent())
        streams[key] = open(p.toUri().getPath(), "wb") if fs.getScheme() == "file" else fs.create(p, True)  # noqa: SIM115
    held = {r["shard"]: r["n"] for r in chunks.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per shard
    width = manifest["seq_len"] * (np.dtype(dtype).itemsize + 1) + 5
    groups, room = [], 0
    for shard in sorted(held):
        if room < held[shard] * width:
            groups.append([])
            room = FLAT_BYTES
        groups[-1].append(shard)
        room -= held[shard] * width
    for shards in groups:
        for row in sorted(_encoded(chunks.filter(F.col("shard").between(shards[0], shards[-1])), manifest["source_ids"], dtype).collect(), key=lambda r: r["first"]):
            for key, stream in streams.items():
                stream.write(row[key])
    for stream in streams.values():
        stream.close()
    metadata = {"num_chunks": manifest["total_chunks"], "seq_len": manifest["seq_len"], "dtype": dtype, "source_id_to_name": {str(i): s for s, i in manifest["source_ids"].items()}, **{k: f"{out}/{n}" for k, n in FLAT.items()}}
    write_json(spark, f"{out}/metadata.json", metadata)
    return metadata


def flat_dtype(written: str | None) -> str:
    """A stored integer type, also as numpy prints its class; uint16 if it is unknown."""
    name = re.search(r"\b(?:uint(?:8|16|32|64)|int(?:8|16|32|64))\b", written or "")
    return name[0] if name else "uint16"


def _records(spark: SparkSession, paths: Sequence[str], width: int) -> DataFrame:
    """(number, content): records of ``width`` bytes of binary files, numbered through the files in their order. Files are split between records, whatever their size."""
    sc = spark.sparkContext
    out, before = None, 0
    for path in paths:
        fs, p = _file(spark, path)
        size = fs.getFileStatus(p).getLen()
        if size % width:
            raise CacheError(f"{path} is no whole number of records of {width} bytes")
        if not size:
            continue
        read = sc.newAPIHadoopFile(path, "org.apache.hadoop.mapreduce.lib.input.FixedLengthInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable", conf={"fixedlengthinputformat.record.length": str(width)})
        part = spark.createDataFrame(read, "at bigint, content binary").select((F.col("at") / width + before).cast("bigint").alias("number"), "content")
        out = part if out is None else out.unionByName(part)
        before += size // width
    return out if out is not None else spark.createDataFrame([], "number bigint, content binary")


def _decoded(records: DataFrame, kind: str, out: str, element: str) -> DataFrame:
    """(number, ``out``): records as arrays of integers."""

    def run(it):
        import numpy as np
        import pyarrow as pa

        for batch in it:
            cells = batch.column(1).to_pylist()
            values = np.frombuffer(b"".join(cells), np.dtype(kind).newbyteorder("<")).astype(np.int64)
            each = len(values) // max(len(cells), 1)
            offsets = pa.array(np.arange(len(cells) + 1, dtype=np.int32) * each)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(values).cast(pa.int32() if element == "int" else pa.int64()))], ["number", out])

    return records.mapInArrow(run, f"number bigint, {out} array<{element}>")


def import_flat(spark: SparkSession, tokens: str | Sequence[str], length: int, dtype: str | None, source_ids: str | None = None, token_sources: str | None = None, valid_lengths: str | None = None, names: dict[int, str] | None = None) -> DataFrame:
    """Chunks of flat arrays: (chunk_id, tokens) and, of the arrays given, source, token_sources and valid_length.

    Several token files are one array. A source number without a name is named by its digits; 0 is padding.
    """
    import numpy as np

    kind = flat_dtype(dtype)
    paths = [tokens] if isinstance(tokens, str) else list(tokens)
    out = _decoded(_records(spark, paths, length * np.dtype(kind).itemsize), kind, "tokens", "bigint").withColumnRenamed("number", "chunk_id")
    listed = F.create_map(*[F.lit(x) for i, n in (names or {}).items() for x in (int(i), n)]) if names else F.lit(None).cast("map<int,string>")
    named = lambda c: F.coalesce(F.element_at(listed, c), c.cast("string"))
    for path, width, item, column, take in (
        (source_ids, 1, "uint8", "source", lambda c: named(c[0])),
        (token_sources, length, "uint8", "token_sources", lambda c: F.transform(c, lambda x: F.when(x > 0, named(x)))),
        (valid_lengths, 4, "uint32", "valid_length", lambda c: c[0].cast("bigint")),
    ):
        if path:
            more = _decoded(_records(spark, [path], width), item, "_v", "int").select(F.col("number").alias("_n"), take(F.col("_v")).alias(column))
            out = out.join(more, F.col("chunk_id") == F.col("_n")).drop("_n")
    return out


def read_flat(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks of a folder that export_flat wrote, by its metadata."""
    m = read_json(spark, f"{folder}/metadata.json")
    if not m:
        raise CacheError("no metadata")
    names = {int(k): v for k, v in m.get("source_id_to_name", {}).items()}
    return import_flat(spark, m["tokens"], m["seq_len"], m["dtype"], m.get("source_ids"), m.get("token_sources"), m.get("valid_lengths"), names)
