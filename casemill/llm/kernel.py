"""Words, hashes and offsets of text columns, computed with numpy inside tasks.

Texts are handled as UTF-8 bytes. Words are runs of bytes other than 0x20 and 0x09-0x0D, which in
UTF-8 is the same as runs of such characters. Hashes are 64 bits wide and depend on the bytes
only, so they agree between tasks, runs and machines.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * BASE)
_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 4096)
        ones = np.full(size, BASE, U64)
        ones[0] = 1
        _powers = np.cumprod(ones)
        ones[1:] = U64(pow(int(BASE), -1, 1 << 64))
        _inverses = np.cumprod(ones)
    return _powers[:n], _inverses[:n]


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums for ``span_hash``: one more entry than there are bytes."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes [start, end) that doesn't depend on where they stand."""
    inverse = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U64) * BASE)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lowered; all other bytes as they are."""
    return _LOWER[data]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give memory that is no longer used back to the system: workers live on from task to task, and
    what one stage's arrays needed would otherwise stay with them."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def as_text(column: pa.Array) -> pa.Array:
    """The column as plain strings, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a text column, a bounded number of bytes at a
    time; a longer text comes alone. Offsets have one more entry than there are rows."""
    column = as_text(column)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
    release()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row (plus one) the index of its first word."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    starts = np.flatnonzero(inside & (~before[:-1] | edge[:-1]))
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    ends = np.flatnonzero(inside & (~after[1:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and for each row (plus one) the index of its first word."""
    starts, ends, first = word_spans(data, offsets)
    return span_hash(rolling(data), starts, ends), first


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct sorted hashes of the runs of ``n`` words; with fewer words, of the whole sequence;
    without words, none."""
    if not len(words):
        return words
    width = min(n, len(words))
    total = np.zeros(len(words) - width + 1, U64)
    for k in range(width):
        total = (total + words[k : len(words) - width + 1 + k]) * BASE
        total ^= total >> U64(29)
    return np.unique(mix(total + U64(width)))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


def rows(**columns) -> pa.RecordBatch:
    """A record batch of named arrays."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()], names=list(columns))


def binaries(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, pa.binary())


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An array column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), pa.array(values, kind))
