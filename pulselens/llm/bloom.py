"""Blocked Bloom filters: a key sets and tests six bits of one 512-bit block, so a probe touches one cache line.

A filter's blocks are built where Spark has dealt the keys (a region of blocks to a row) and put together on the driver,
whose share is the filter's size: a parameter, never the number of keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import mix

U64 = np.uint64
#: Bits of a block, bits set for a key, blocks of a region (64 KB).
BLOCK_BITS, PROBES, REGION = 512, 6, 1024


def _bits(h: np.ndarray) -> np.ndarray:
    """54 bits, nine for each probe, independent of those that choose the block."""
    return mix(h ^ U64(0xA0761D6478BD642F))


def block_of(h: np.ndarray, n_blocks: int | np.ndarray) -> np.ndarray:
    """The block of each hash, by its upper 32 bits: hashes in ascending order have ascending blocks."""
    return ((h >> U64(32)) * np.asarray(n_blocks, U64) >> U64(32)).astype(np.int64)


def blocks(h: np.ndarray, block: np.ndarray, first: int, n: int) -> np.ndarray:
    """The bytes of the blocks ``first`` to ``first + n`` that the keys ``h`` in ``block`` fill."""
    flag = np.zeros(n * BLOCK_BITS, bool)
    base, g = (block - first) * BLOCK_BITS, _bits(h)
    for i in range(PROBES):
        flag[base + (g >> U64(9 * i) & U64(511)).astype(np.int64)] = True
    return np.packbits(flag, bitorder="little")


def holds(data: np.ndarray, h: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Indices of the hashes that the filter may hold; each probe is made only for those that passed the ones before."""
    rows, base, g = np.arange(len(h)), block * (BLOCK_BITS // 8), _bits(h)
    for i in range(PROBES):
        bit = (g >> U64(9 * i) & U64(511)).astype(np.int64)
        hit = (data[base + (bit >> 3)] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
        rows, base, g = rows[hit], base[hit], g[hit]
    return rows


def gather(keys: DataFrame, n_blocks: int) -> bytearray:
    """The filter of ``keys (block, h)``, whose blocks are below ``n_blocks``: ``64 * n_blocks`` bytes on the driver."""
    def build(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        first = int(block[0]) // REGION * REGION if len(block) else 0
        made = blocks(table.column("h").to_numpy().view(U64), block, first, REGION)
        return pa.table({"first": pa.array([first], pa.int64()), "bits": pa.array([made.tobytes()], pa.binary())})

    out = bytearray(n_blocks * BLOCK_BITS // 8)
    rows = keys.selectExpr("block", "h", f"block div {REGION} as region").groupBy("region").applyInArrow(build, "first long, bits binary")
    for r in rows.collect():
        at = r.first * (BLOCK_BITS // 8)
        part = bytes(r.bits)[:len(out) - at]
        out[at:at + len(part)] = part
    return out
