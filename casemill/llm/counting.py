"""Exact counts of very many 64-bit keys, shuffled as packed blocks, and a log-frequency Bloom
filter over them.

Keys are cut to 48 bits. A task sorts and counts about a million at a time and sends, for each
block of keys, one row with 5 bytes a key and 4 a count; a block is added up by itself. Keys seen
once are left out of ``seen_again``; ``levelled`` has all."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitfilter, kernel

U64 = np.uint64
LEVELS = 48
PACKED = "block int, keys binary, counts binary"
LEVELLED = "block int, keys binary, levels binary, kinds array<long>, total array<long>"
SLICE = 1 << 17


def packed(keys: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Blocks of the counted keys, an array of keys at a time."""
    for some in keys:
        key, n = np.unique(some >> U64(16), return_counts=True)
        used, start = np.unique((key >> U64(38)).astype(np.int32), return_index=True)
        end = np.append(start[1:], len(key))
        low = np.ascontiguousarray(key & U64((1 << 38) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]
        n = n.astype(np.uint32)
        yield kernel.rows(
            block=used, keys=kernel.binaries([low[a:b].tobytes() for a, b in zip(start, end)]),
            counts=kernel.binaries([n[a:b].tobytes() for a, b in zip(start, end)]),
        )


def unpacked(low: bytes) -> np.ndarray:
    """Keys within a block from their 5 bytes each."""
    wide = np.zeros((len(low) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(low, np.uint8).reshape(-1, 5)
    return wide.view(U64).ravel()


def split(key: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Blocks of sorted 48-bit keys, each block's keys in 5 bytes each, and where the blocks begin and end."""
    used, start = np.unique((key >> U64(38)).astype(np.int32), return_index=True)
    bounds = np.append(start, len(key))
    low = np.ascontiguousarray(key & U64((1 << 38) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]
    return used, [low[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], bounds


def _sums(t: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    """A block, its keys and their counts."""
    key, where = np.unique(unpacked(b"".join(t["keys"].to_pylist())), return_inverse=True)
    n = np.bincount(where, np.frombuffer(b"".join(t["counts"].to_pylist()), np.uint32), len(key)).astype(np.int64)
    return t["block"][0].as_py(), key, n


def _added(t: pa.Table) -> pa.Table:
    block, key, n = _sums(t)
    again = n > 1
    return pa.table({"key": pa.array(kernel.signed(key[again] | U64(block << 38))), "n": pa.array(n[again])})


def _levelled(t: pa.Table) -> pa.Table:
    block, key, n = _sums(t)
    q = np.floor(np.log2(n)).astype(np.int64) + 1
    low = key.view(np.uint8).reshape(-1, 8)[:, :5]
    at = range(0, len(key), SLICE)
    each = [(q[i : i + SLICE], n[i : i + SLICE]) for i in at]
    longs = pa.list_(pa.int64())
    return pa.table({
        "block": pa.array([block] * len(each), pa.int32()), "keys": kernel.binaries([low[i : i + SLICE].tobytes() for i in at]),
        "levels": kernel.binaries([a.astype(np.uint8).tobytes() for a, _ in each]),
        "kinds": pa.array([np.bincount(a, minlength=LEVELS).tolist() for a, _ in each], longs),
        "total": pa.array([np.bincount(a, b, LEVELS).astype(np.int64).tolist() for a, b in each], longs),
    })


def seen_again(rows: DataFrame, run: Callable) -> DataFrame:
    """(key, n) of the 48-bit keys counted twice and more; ``run`` makes ``packed`` rows."""
    return rows.mapInArrow(run, PACKED).groupBy("block").applyInArrow(_added, "key long, n long")


def levelled(rows: DataFrame, run: Callable) -> DataFrame:
    """All keys, also those seen once, with the levels of their counts: ``SLICE`` sorted keys of a block a row, and
    how many keys and what counts (``kinds``, ``total``) each level has in it. ``run`` makes ``packed`` rows."""
    return rows.mapInArrow(run, PACKED).groupBy("block").applyInArrow(_levelled, LEVELLED)


def level(n: str):
    """1 for a count of 1, and one more for each doubling."""
    return (F.floor(F.log2(F.col(n))) + 1).cast("int")


def levels(filter_: np.ndarray, bits: int, probes: int, keys: np.ndarray, lowest: int) -> np.ndarray:
    """The level of each key, 0 for one that isn't stored: probes go up until a level is missing."""
    found = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    for q in range(lowest, LEVELS):
        alive = alive[bitfilter.contains(filter_, keys[alive], bits, probes, q)]
        if not len(alive):
            break
        found[alive] = q
    return found


def load(kinds: np.ndarray, low: int) -> int:
    """How many entries a filter gets from ``kinds`` keys per level, stored from level ``low``."""
    return int((kinds * np.maximum(0, np.arange(len(kinds)) - low + 1)).sum())
