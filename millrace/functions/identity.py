"""Hashes and identities of documents."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def document_hash(text: Column) -> Column:
    """SHA-256 in hex of the UTF-8 bytes, without normalisation."""
    return F.sha2(text.cast("binary"), 256)


def document_id(repo: Column, revision: Column, config: Column, split: Column, ordinal: Column, text: Column | None = None, digest: Column | None = None) -> Column:
    """'doc_' and the SHA-256 of the compact JSON list of the coordinates and the text's hash (given by itself where it is known).

    Coordinates must not hold control characters, which JSON writers escape in
    different ways.
    """
    head = F.to_json(F.array(repo, revision, config, split))
    listed = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(","), ordinal.cast("string"), F.lit(',"'), document_hash(text) if digest is None else digest, F.lit('"]'))
    whole = repo.isNotNull() & revision.isNotNull() & config.isNotNull() & split.isNotNull()
    return F.when(whole, F.concat(F.lit("doc_"), F.sha2(listed.cast("binary"), 256)))


def split_bound(fraction: float) -> str:
    """The share of the 256-bit range as 64 hex digits; SHA-256 digests below it belong to it."""
    return format(min(int(Fraction(fraction) * (1 << 256)), (1 << 256) - 1), "064x")


def content_split(digest: Column, fraction: float, seed: int) -> Column:
    """'validation' or 'train' by the content's hash alone, so copies never part."""
    keyed = F.sha2(F.concat(F.lit(f"{seed}:"), digest).cast("binary"), 256)
    return F.when(digest.isNull(), F.lit(None)).when(keyed < split_bound(fraction), "validation").otherwise("train")


def is_revision(c: Column) -> Column:
    """Forty lower-case hex digits and nothing else."""
    return F.coalesce(c.rlike(r"\A[0-9a-f]{40}\z"), F.lit(False))
