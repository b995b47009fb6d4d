"""Words and word shingles of Arrow text columns as 64-bit hashes, in numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.
Words are hashed by a multilinear form with random 64-bit coefficients, so two
different words share a hash with a chance of 2**-57 at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Text bytes handled at once; a longer single text is handled alone.
BLOCK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240117)
_COEFFICIENTS = _RANDOM.integers(1, 2**64, size=1024, dtype=np.uint64)
_SHINGLE = _RANDOM.integers(1, 2**64, size=64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coefficients(n: int) -> np.ndarray:
    global _COEFFICIENTS
    if n > len(_COEFFICIENTS):
        more = np.random.default_rng(len(_COEFFICIENTS)).integers(1, 2**64, size=2 * n, dtype=np.uint64)
        _COEFFICIENTS = np.concatenate([_COEFFICIENTS, more])
    return _COEFFICIENTS[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with about `limit` bytes."""
    data, offsets = text_buffers(column)
    at, n = 0, len(column)
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word, and where each text's words start (n + 1 entries).

    `space` marks the bytes that separate words.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, np.zeros(len(offsets), np.int64)
    lengths = ends - starts
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
    values = LOWER[data[inside]].astype(np.uint64) + np.uint64(1)
    values *= _coefficients(int(lengths.max()))[at]
    hashes = mix(np.add.reduceat(values, heads) + lengths.astype(np.uint64))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def shingle_windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each word on."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * _SHINGLE[j]
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Each text's distinct k-word shingles, ascending.

    With fewer than k words the whole sequence counts as one; without a word the set is empty.
    """
    hashes, _, _, bounds = words(data, offsets)
    windows = shingle_windows(hashes, k)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= k:
            out.append(np.unique(windows[a : b - k + 1]))
        elif b > a:
            few = (hashes[a:b] * _SHINGLE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([few], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(data: bytes) -> tuple[int, int]:
    """128 bits as two signed longs."""
    raw = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose i-th entry holds the next counts[i] rows of `values`."""
    width = values.dtype.itemsize * int(np.prod(values.shape[1:], dtype=np.int64))
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * width
    if ends[-1] < 2**31:
        offsets, kind = pa.py_buffer(ends.astype(np.int32)), pa.binary()
    else:
        offsets, kind = pa.py_buffer(ends), pa.large_binary()
    return pa.Array.from_buffers(kind, len(counts), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])
