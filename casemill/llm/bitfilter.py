"""Bloom filters of a fixed size, built in blocks by Spark tasks and broadcast.

The high bits of a 64-bit key choose one of ``BLOCKS`` blocks; all probes of a key stay inside it,
so a block can be built by one task from its own keys alone. The driver gets the finished bits,
whose number is a parameter, and never the keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel
from .tables import ship

BLOCK_BITS = 8
BLOCKS = 1 << BLOCK_BITS


def places(keys: np.ndarray, bits: int, probes: int, level: np.ndarray | int = 0) -> np.ndarray:
    """[key, probe] bit numbers in the whole filter of 2**bits bits. Levels of a key are keys of
    their own in the same block."""
    keys = kernel.mix(keys)
    inner = np.uint64(bits - BLOCK_BITS)
    block = (keys >> np.uint64(64 - BLOCK_BITS)) << inner
    keys = kernel.mix(keys + np.asarray(level).astype(np.uint64))
    mask = (np.uint64(1) << inner) - np.uint64(1)
    step = kernel.mix(keys ^ np.uint64(0xA5A5A5A55A5A5A5A)) | np.uint64(1)
    at = keys[:, None] * np.uint64(0xD1342543DE82EF95) + np.arange(1, probes + 1, dtype=np.uint64) * step[:, None]
    return block[:, None] | ((at >> np.uint64(20)) & mask)


def block_of(keys: np.ndarray) -> np.ndarray:
    return (kernel.mix(keys) >> np.uint64(64 - BLOCK_BITS)).astype(np.int32)


def contains(filter_: np.ndarray, keys: np.ndarray, bits: int, probes: int, level: int = 0) -> np.ndarray:
    """True where the key was added, and seldom elsewhere."""
    found = np.ones(len(keys), bool)
    alive = np.arange(len(keys))
    at = places(keys, bits, probes, level)
    for k in range(probes):
        p = at[alive, k]
        hit = (filter_[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
        found[alive[hit == 0]] = False
        alive = alive[hit == 1]
    return found


def set_bits(filter_: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(filter_, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _numbered(batches):
    for batch in batches:
        keys = np.asarray(batch.column("key")).view(np.uint64)
        yield kernel.rows(block=pa.array(block_of(keys)), key=batch.column("key"), low=batch.column("low"), high=batch.column("high"))


def _build(bits: int, probes: int):
    size = (1 << (bits - BLOCK_BITS)) // 8

    def run(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            low, high = np.asarray(batch.column("low")), np.asarray(batch.column("high"))
            times = high - low + 1
            blocks = np.repeat(np.asarray(batch.column("block")), times)
            keys = np.repeat(np.asarray(batch.column("key")).view(np.uint64), times)
            level = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = places(keys, bits, probes, level)
            for block in np.unique(blocks):
                if block not in parts:
                    parts[block] = np.zeros(size, np.uint8)
                set_bits(parts[block], at[blocks == block].ravel() - np.uint64(int(block) * size * 8))
        yield kernel.rows(block=pa.array(list(parts), pa.int32()), bits=kernel.binaries([p.tobytes() for p in parts.values()]))

    return run


def build(keys: DataFrame, bits: int, probes: int) -> np.ndarray:
    """The filter over the long column ``key`` as bytes on the driver. With int columns low and
    high, the key is added with each level from low to high, without them with level 0.

    All blocks are built in one job: taken one partition at a time, they would be as many jobs."""
    ship(keys.sparkSession)
    level = (lambda c: F.col(c) if c in keys.columns else F.lit(0).alias(c))
    blocks = (
        keys.select("key", level("low"), level("high")).mapInArrow(_numbered, "block int, key long, low int, high int")
        .repartition(BLOCKS // 8, "block")
        .mapInArrow(_build(bits, probes), "block int, bits binary")
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    size = len(out) // BLOCKS
    for row in blocks.collect():
        out[row.block * size : (row.block + 1) * size] |= np.frombuffer(row.bits, np.uint8)
    return out


@contextmanager
def shared(spark: SparkSession, bits: bytes) -> Iterator[Broadcast]:
    """A finished filter on all executors. Every one keeps a copy on its disk and the driver another;
    they go when the block ends, so what asks the filter must be written inside."""
    handle = spark.sparkContext.broadcast(bits)
    try:
        yield handle
    finally:
        handle.destroy()
