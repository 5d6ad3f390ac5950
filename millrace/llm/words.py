"""Words of texts, in vectorised batches.

Words: NFKD, marks (M) and format characters (Cf) dropped, lower case, dotless
i as i, then maximal runs of letters and numbers. Null and empty texts have no
words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Code points that one vectorised slice holds at most (a longer text is a slice of its own).
SLICE_CHARS = 4_000_000
#: Bytes of word hashes that are worked on at a time.
PORTION_BYTES = 4_000_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows that stay under SLICE_CHARS together."""
    start = held = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > SLICE_CHARS:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def word_lists(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """All words of the texts in one list, and the offsets of each text in it."""
    import regex

    joined = "\0".join((t or "").replace("\0", " ") for t in texts)
    if not joined.isascii():
        joined = regex.sub(r"[\p{M}\p{Cf}]+", "", unicodedata.normalize("NFKD", joined))
    joined = joined.lower().replace("ı", "i")
    if "̇" in joined:
        joined = joined.replace("̇", "")
    found = regex.findall(r"[\p{L}\p{N}]+|\0", joined)
    is_end = np.fromiter((w == "\0" for w in found), bool, len(found))
    ends = np.append(np.flatnonzero(is_end), len(found)) - np.arange(len(texts))
    return [w for w in found if w != "\0"] if is_end.any() else found, np.concatenate([[0], ends])


def hash_words(words: list[str]) -> np.ndarray:
    """A 32-bit hash of each word, never 0; each distinct word is hashed once."""
    import xxhash

    if not words:
        return np.empty(0, np.uint32)
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    table = np.fromiter((xxhash.xxh32_intdigest(w) or 1 for w in coded.dictionary.to_pylist()), np.uint32, len(coded.dictionary))
    return table[coded.indices.to_numpy(zero_copy_only=False)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def triples(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the consecutive word triples of each text, in order, and each text's offsets."""
    counts = np.maximum(np.diff(offsets) - 2, 0)
    out = np.concatenate([[0], np.cumsum(counts)])
    if not out[-1]:
        return np.empty(0, np.uint64), out
    h = hashes.astype(np.uint64)
    at = np.arange(out[-1]) + np.repeat(offsets[:-1] - out[:-1], counts)
    return mix((h[at] * _M1) ^ mix(h[at + 1] * _M2 + mix(h[at + 2] + _M3))), out


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and the new offsets."""
    n = np.diff(offsets)
    if not len(values):
        return values, offsets
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    keep = np.append(True, (v[1:] != v[:-1]) | (o[1:] != o[:-1]))
    return v[keep], np.concatenate([[0], np.cumsum(np.bincount(o[keep], minlength=len(n)))])


def binary_list(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Each text's values as one binary cell (little endian)."""
    at = (np.asarray(offsets) * values.dtype.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def from_binary(cells: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Undo binary_list; nulls count as empty."""
    if isinstance(cells, pa.ChunkedArray):
        cells = cells.combine_chunks()
    if pa.types.is_binary(cells.type):
        cells = cells.cast(pa.large_binary())
    at = np.frombuffer(cells.buffers()[1], np.int64, len(cells) + 1, cells.offset * 8)
    data = cells.buffers()[2]
    size = np.dtype(dtype).itemsize
    whole = np.frombuffer(data, dtype, (at[-1] - at[0]) // size, at[0]) if data is not None and at[-1] > at[0] else np.empty(0, dtype)
    return whole, (at - at[0]) // size


def portions(batch: pa.RecordBatch, columns: Sequence[int], most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose binary cells stay under ``most`` bytes together (a larger row is a run of its own)."""
    size = np.zeros(batch.num_rows, np.int64)
    for k in columns:
        size += pc.fill_null(pc.binary_length(batch.column(k)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def hamming(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hamming distance of the indicator vectors of the i-th set of ``a`` and the i-th of ``b`` (sorted distinct values)."""
    n = len(a[1]) - 1
    owner = np.concatenate([np.repeat(np.arange(n), np.diff(a[1])), np.repeat(np.arange(n), np.diff(b[1]))])
    values = np.concatenate([a[0], b[0]])
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    same = np.bincount(o[1:][(v[1:] == v[:-1]) & (o[1:] == o[:-1])], minlength=n) if len(v) else np.zeros(n, np.int64)
    return np.diff(a[1]) + np.diff(b[1]) - 2 * same
