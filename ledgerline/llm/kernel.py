"""Array kernels over whole texts: words, word hashes, word windows.  Used inside Spark tasks only.

A batch of texts is handled as one byte array per chunk of about a megabyte, so the temporaries
of a task stay small whatever the batch holds; a single longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (shift-multiply rounds) applied to every element."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random 64-bit constants, a function of ``seed`` only."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(_P) + _U(seed)) | _U(1)


BYTE_CODE = constants(256, 7)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse (kept up to one chunk's length)."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 1))
    out = []
    for base in (_P, _P_INV):
        table = np.full(size, base, np.uint64)
        table[0] = 1
        out.append(np.multiply.accumulate(table))
    if size <= 2 * CHUNK_BYTES:
        _POWERS[:] = out
    return out[0][:n], out[1][:n]


@dataclass
class Words:
    """Words of a chunk of texts: byte spans in ``data``, the text of each, 64-bit hashes."""

    data: np.ndarray  # the chunk's bytes, texts joined by a line break
    first: np.ndarray  # byte offset of every text in the chunk
    start: np.ndarray  # word starts
    end: np.ndarray  # word ends (exclusive)
    text: np.ndarray  # index of the word's text in the chunk
    hash: np.ndarray  # hash of the word's bytes (lower-cased A-Z when asked for)
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]


def chunks(texts: Iterable[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts in groups of about ``limit`` bytes, with the index of the first."""
    group: list[bytes] = []
    at = size = 0
    for i, text in enumerate(texts):
        text = text or b""
        if group and size + len(text) > limit:
            yield at, group
            group, at, size = [], i, 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield at, group


def words(texts: list[bytes], lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text of a chunk."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    first = np.zeros(len(texts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    space = _SPACE[data]
    inside = np.empty(len(data) + 1, bool)
    inside[0] = False
    np.logical_not(space, out=inside[1:])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    codes = BYTE_CODE[_LOWER[data] if lower else data]
    power, inverse = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes * power, out=total[1:])
    hashed = mix((total[end] - total[start]) * inverse[start])
    bounds = np.searchsorted(start, np.append(first, len(data)))
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(data, first, start, end, text, hashed, bounds)


def windows(w: Words, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k``-word window that lies in one text, and the index of its first word."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(w.text[:n] == w.text[k - 1 :])
    out = np.zeros(n, np.uint64)
    for j, c in enumerate(constants(k, seed)):
        out += w.hash[j : j + n] * c
    return mix(out[at]), at


def slices(batches: Iterable[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices, so that a task holds the values of a few texts at a time
    and not of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def list_column(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Array column whose row i is ``values[bounds[i]:bounds[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))
