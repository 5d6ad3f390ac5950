"""Encoding texts with a tokenizer that is given as an object.

A tokenizer has ``encode(text, add_special_tokens=False)`` and may have
``eos_token_id``, ``pad_token_id``, ``vocab_size`` or a length, and
``get_vocab``. It is pickled once per job and used in Arrow batches.
"""

from __future__ import annotations

import hashlib
import json
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class FileTokenizer:
    """A public tokenizer from its file: byte-level ranks (.tiktoken), a tokenizers file (.json) or a sentencepiece model (.model).

    Loaded where it is first used, so that a job carries its path only; the
    file must be at that path on every machine. Marker strings in a text are
    ordinary text.
    """

    #: Pre-tokens of byte-level ranks (fixed value).
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, eos_token_id: int | None = None, pad_token_id: int | None = None):
        self.path, self.eos_token_id, self.pad_token_id = path, eos_token_id, pad_token_id
        self._loaded = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_loaded": None}

    def _model(self):
        if self._loaded is None:
            if self.path.endswith(".tiktoken"):
                import base64

                import tiktoken

                with open(self.path, "rb") as f:
                    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
                self._loaded = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
            elif self.path.endswith(".json"):
                from tokenizers import Tokenizer

                self._loaded = Tokenizer.from_file(self.path)
                self._loaded.encode_special_tokens = True
            elif self.path.endswith(".model"):
                import sentencepiece

                self._loaded = sentencepiece.SentencePieceProcessor(model_file=self.path)
            else:
                raise ValueError(f"{self.path} is no tokenizer file of a known kind")
        return self._loaded

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        model = self._model()
        if self.path.endswith(".tiktoken"):
            return model.encode_ordinary_batch(texts, num_threads=1)
        if self.path.endswith(".json"):
            return [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
        return model.encode(texts, num_threads=1)

    def encode(self, text: str, add_special_tokens: bool = False) -> list[int]:
        return self.encode_batch([text])[0]

    def __len__(self) -> int:
        """Ids up to the largest of the vocabulary and the special ones."""
        model = self._model()
        size = model.n_vocab if self.path.endswith(".tiktoken") else model.get_vocab_size(with_added_tokens=True) if self.path.endswith(".json") else model.get_piece_size()
        return max(size, *(i + 1 for i in (self.eos_token_id, self.pad_token_id) if i is not None), 0)

    def get_vocab(self) -> dict[str, int]:
        model = self._model()
        if self.path.endswith(".tiktoken"):
            return {b.hex(): i for b, i in model._mergeable_ranks.items()}
        if self.path.endswith(".json"):
            return model.get_vocab(with_added_tokens=True)
        return {model.id_to_piece(i): i for i in range(model.get_piece_size())}

    def settings(self) -> dict:
        """What besides the vocabulary decides how a text is cut: the file's other parts, or the pattern."""
        if self.path.endswith(".json"):
            whole = json.loads(self._model().to_str())
            return {**whole, "model": {k: v for k, v in whole["model"].items() if k != "vocab"}}
        return {"pattern": self.PATTERN} if self.path.endswith(".tiktoken") else {"model": hashlib.sha256(open(self.path, "rb").read()).hexdigest()}


def legacy_special_ids(tokenizer) -> tuple[int, int]:
    """(end, pad) of an older packer, which took a pad id of 0 for none and padded with the end id."""
    end, _ = special_ids(tokenizer)
    return end, getattr(tokenizer, "pad_token_id", None) or end


def vocabulary_size(tokenizer) -> int:
    """With added tokens where the tokenizer tells its length."""
    try:
        return len(tokenizer)
    except TypeError:
        return tokenizer.vocab_size


def special_ids(tokenizer) -> tuple[int, int]:
    """(end, pad): the end id, else the pad id, else 0; the pad id, else the end id. Id 0 is an id."""
    end, pad = getattr(tokenizer, "eos_token_id", None), getattr(tokenizer, "pad_token_id", None)
    end = end if end is not None else (pad if pad is not None else 0)
    return end, pad if pad is not None else end


def id_type(size: int) -> str:
    """Narrowest stored type of ids."""
    return "uint16" if size <= 65_536 else "uint32"


def fingerprint(tokenizer) -> str:
    """SHA-256 over size, special ids, vocabulary and settings (merges, normaliser and the like); the same wherever the tokenizer was loaded from."""
    vocab = tokenizer.get_vocab() if hasattr(tokenizer, "get_vocab") else None
    settings = tokenizer.settings() if hasattr(tokenizer, "settings") else None
    parts = {"size": vocabulary_size(tokenizer), "special": special_ids(tokenizer), "vocab": sorted(vocab.items()) if vocab else None, "settings": settings}
    return hashlib.sha256(json.dumps(parts, ensure_ascii=False).encode()).hexdigest()


def encode(df: DataFrame, text: str, tokenizer, out: str = "tokens") -> DataFrame:
    """Add the ids of each text as an int array; null and empty texts have none. An id outside the vocabulary is an error."""
    size = vocabulary_size(tokenizer)
    schema = df.select("*", F.array().cast("array<int>").alias(out)).schema
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(tokenizer))
    at = df.columns.index(text)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = pickle.loads(shared.value)
        for batch in it:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            many = tok.encode_batch(texts) if hasattr(tok, "encode_batch") else [tok.encode(t, add_special_tokens=False) for t in texts]
            if len(many) != len(texts):
                raise ValueError("a tokenizer must give one list for each text")
            ids = [list(i) if t else [] for t, i in zip(texts, many)]
            if any(i < 0 or i >= size for row in ids for i in row):
                raise ValueError("a token is outside the vocabulary")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def appended_only(base: DataFrame, extended: DataFrame) -> DataFrame:
    """Violations of an append-only vocabulary (token, id): lost or moved tokens, and new ids below the base or with gaps.

    Empty when the extension keeps every id and adds a contiguous block after the base.
    """
    b = base.select(F.col("token").alias("bt"), F.col("id").alias("bi"))
    lost = b.join(extended, (F.col("bt") == F.col("token")) & (F.col("bi") == F.col("id")), "left_anti").select(F.col("bt").alias("token"), F.col("bi").alias("id"), F.lit("lost_or_moved").alias("violation"))
    new = extended.join(b.select("bt"), F.col("token") == F.col("bt"), "left_anti")
    outside = new.filter((F.col("id") < base.count()) | (F.col("id") >= extended.count())).select("token", "id", F.lit("outside_block").alias("violation"))
    twice = extended.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("token").alias("token")).filter("c > 1").select("token", "id", F.lit("repeated_id").alias("violation"))
    return lost.unionByName(outside).unionByName(twice)


def changed_settings(base: dict, extended: dict) -> list[str]:
    """What an extended tokenizer changes of its base's settings (see FileTokenizer.settings): parts, model options, merges that don't begin with the base's, and added tokens."""
    out = [part for part in ("normalizer", "pre_tokenizer", "decoder", "post_processor") if base.get(part) != extended.get(part)]
    old, new = base.get("model") or {}, extended.get("model") or {}
    if isinstance(old, dict) and isinstance(new, dict):
        options = lambda m: {k: v for k, v in m.items() if k not in ("vocab", "merges")}
        out += ["model options"] * (options(old) != options(new))
        merges = old.get("merges") or []
        out += ["merges"] * ((new.get("merges") or [])[: len(merges)] != merges)
    elif old != new:
        out.append("model")
    known = {t["content"]: t for t in extended.get("added_tokens") or []}
    return out + [f"added token {t['content']}" for t in base.get("added_tokens") or [] if known.get(t["content"]) != t]
