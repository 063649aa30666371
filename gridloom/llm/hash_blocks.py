"""Counting 64-bit hashes across the corpus in packed form.

Rows are dealt into blocks by a deterministic key.  Each block sorts its hashes,
collapses equal ones and sends one packed row per range of the hash space; the
task that owns a range merges the blocks' lists and answers each block with one
entry per hash it sent, in the same order.  So a hash that occurs in a third of
all rows costs one entry per block, and no hash is ever a shuffle key.
"""

from __future__ import annotations

import math

import numpy as np

#: Text of a block; it grows with the root of the corpus between these bounds,
#: so that blocks x ranges stays below the number of hashes.
BLOCK_BYTES = (8 << 20, 64 << 20)


def plan(total_bytes: int, block_bytes: tuple[int, int] = BLOCK_BYTES) -> tuple[int, int]:
    """Number of blocks, and bits of the hash that name its range (about a block's worth of hashes)."""
    size = min(block_bytes[1], max(block_bytes[0], int(math.sqrt(total_bytes * 1024))))
    blocks = max(1, math.ceil(total_bytes / size))
    return blocks, max(0, math.ceil(math.log2(blocks)))


def pack(hashes: np.ndarray) -> bytes:
    """Ascending hashes as differences, byte plane by byte plane (the shuffle's compressor drops the zero planes)."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def range_edges(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each range of the hash space begins in ascending ``hashes``; one more entry than ranges."""
    marks = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, marks), [len(hashes)]])


def pack_wide(high: np.ndarray, low: np.ndarray) -> bytes:
    """Hashes of 64 and 32 bits, ascending by both."""
    return pack(high) + np.ascontiguousarray(low, np.uint32).tobytes()


def unpack_wide(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 12
    return unpack(packed[:8 * n]), np.frombuffer(packed, np.uint32, n, 8 * n)


def ascending(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of wide hashes by both parts, and where it comes to a new one.

    Equal high parts with different low ones are rare, so the low parts are sorted
    only where there are any.
    """
    order = np.argsort(high)
    h, lo = high[order], low[order]
    same = h[1:] == h[:-1]
    if (same & (lo[1:] != lo[:-1])).any():
        order = np.lexsort((low, high))
        lo = low[order]
    new = np.ones(len(high), bool)
    new[1:] = ~same | (lo[1:] != lo[:-1])
    return order, new
