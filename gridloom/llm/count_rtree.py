"""R-tree over count vectors, searched by an upper bound of set overlap.

A set's point has the number of its elements in each of ``GROUPS`` hash groups.
Two sets share at most the sum of the coordinate-wise minima of their points, and
any set below a node at most the sum of the minima with the node's upper corner.
"""

from __future__ import annotations

import numpy as np

GROUPS = 64
FANOUT = 16


def points(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Group counts of consecutive sets of 64-bit hashes."""
    n = len(first) - 1
    rows = np.repeat(np.arange(n), np.diff(first))
    group = (hashes >> np.uint64(24)).astype(np.int64) & (GROUPS - 1)
    return np.bincount(rows * GROUPS + group, minlength=n * GROUPS).reshape(n, GROUPS).astype(np.int32)


def needed(a: np.ndarray, b: np.ndarray, per_cent: int) -> np.ndarray:
    """The overlap from which sets of sizes a and b have a Jaccard index of ``per_cent`` / 100."""
    return -(-per_cent * (a + b) // (100 + per_cent))


class CountTree:
    """Packed bottom-up from an order that splits the widest coordinate at its median."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.order = self._arrange(vectors, np.arange(len(sizes)))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = [(self.vectors, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > FANOUT:
            high, least, most = self.levels[-1]
            cuts = np.arange(0, len(high), FANOUT)
            self.levels.append((np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)))

    def _arrange(self, vectors, at):
        if len(at) <= FANOUT:
            return at
        own = vectors[at]
        widest = np.argmax(own.max(0) - own.min(0))
        half = -(-len(at) // (2 * FANOUT)) * FANOUT  # whole leaves
        if half >= len(at):
            half = len(at) // 2
        ranked = at[np.argpartition(own[:, widest], half)]
        return np.concatenate([self._arrange(vectors, ranked[:half]), self._arrange(vectors, ranked[half:])])

    def search(self, vectors: np.ndarray, sizes: np.ndarray, per_cent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, set) whose bound reaches the index wanted."""
        query = np.repeat(np.arange(len(sizes)), len(self.levels[-1][0]))
        node = np.tile(np.arange(len(self.levels[-1][0])), len(sizes))
        for level in range(len(self.levels) - 1, -1, -1):
            high, least, most = self.levels[level]
            keep = self._may(vectors, sizes, query, node, high, least, most, per_cent)
            query, node = query[keep], node[keep]
            if level:
                below = len(self.levels[level - 1][0])
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query = np.repeat(query, FANOUT)
                query, node = query[node < below], node[node < below]
        return query, self.order[node]

    @staticmethod
    def _may(vectors, sizes, query, node, high, least, most, per_cent, step=1 << 14):
        out = np.zeros(len(query), bool)
        own = sizes[query]
        fits = np.flatnonzero((100 * most[node] >= per_cent * own) & (per_cent * least[node] <= 100 * own))
        for lo in range(0, len(fits), step):
            at = fits[lo:lo + step]
            bound = np.minimum(vectors[query[at]], high[node[at]]).sum(1)
            # the smallest set below that is not too small asks for the least
            size = np.maximum(least[node[at]], -(-per_cent * own[at] // 100))
            out[at] = bound >= needed(own[at], size, per_cent)
        return out
