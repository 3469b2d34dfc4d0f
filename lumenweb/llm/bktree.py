"""BK-trees over 64-bit fingerprints: a child hangs on the edge that is its Hamming distance to the parent.

By the triangle inequality a search with radius r at distance d from a node follows only the edges d - r to d + r. The
trees of many shards grow and are searched together, level by level, so that each step is one numpy call however small
the trees are. No tree has leaves of several items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Edges are 0 to 64.
EDGES = 65
#: (query, node) pairs that are looked at together.
FRONT = 1_000_000


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """labels: each item's component, named by its smallest item. The labels after linking a with b."""
    labels = labels.copy()
    while len(a):
        x, y = labels[a], labels[b]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]
    return labels


class Forest:
    """items: uint64; tree: the number of each one's tree. An item that is in its tree already is no node but a twin."""

    def __init__(self, items: np.ndarray, tree: np.ndarray, radius: int):
        n = len(items)
        self.items, self.radius, self.visited = items, radius, 0
        self.parent, self.edge, self.depth = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.node = np.ones(n, bool)
        order = np.argsort(tree, kind="stable")
        new = np.ones(n, bool)
        new[1:] = tree[order][1:] != tree[order][:-1]
        roots = order[new]
        #: Trees by number, and their roots.
        self.trees, self.roots = tree[roots], roots
        root = roots[np.cumsum(new) - 1] if n else roots
        wait, at, depth = order[~new], root[~new], 0
        links = []
        while len(wait):
            depth += 1
            far = np.bitwise_count(items[wait] ^ items[at]).astype(np.int64)
            near = far <= radius
            links.append((wait[near], at[near]))
            self.node[wait[far == 0]] = False
            wait, at, far = wait[far > 0], at[far > 0], far[far > 0]
            by = np.argsort(at * EDGES + far, kind="stable")
            wait, at, far = wait[by], at[by], far[by]
            first = np.ones(len(wait), bool)
            first[1:] = (at[1:] != at[:-1]) | (far[1:] != far[:-1])
            grown = wait[first]
            self.parent[grown], self.edge[grown], self.depth[grown] = at[first], far[first], depth
            at = grown[np.cumsum(first) - 1][~first] if len(wait) else wait
            wait = wait[~first]
        #: Links within the radius that an item met on its way to its place.
        self.met = tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*links, strict=True) if links else ((), ())))
        child = np.flatnonzero(self.node & (self.parent >= 0))
        key = self.parent[child] * EDGES + self.edge[child]
        by = np.argsort(key, kind="stable")
        self.child, self.key = child[by], key[by]

    def whole(self, labels: np.ndarray) -> np.ndarray:
        """For each node the label that its whole subtree has, or -1."""
        low, high = labels.copy(), labels.copy()
        for d in range(int(self.depth.max(initial=0)), 0, -1):
            at = np.flatnonzero((self.depth == d) & self.node)
            np.minimum.at(low, self.parent[at], low[at])
            np.maximum.at(high, self.parent[at], high[at])
        return np.where(low == high, low, -1)

    def search(self, wanted: np.ndarray, tree: np.ndarray, own: np.ndarray | None = None, whole: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields (place in wanted, node) within the radius, each fingerprint searched in the tree of its number. With own (labels of wanted) and whole, subtrees that are wholly of the own component aren't entered."""
        at = np.minimum(np.searchsorted(self.trees, tree), max(0, len(self.trees) - 1))
        there = self.trees[at] == tree if len(self.trees) else np.zeros(len(tree), bool)
        stack = [(np.flatnonzero(there), self.roots[at[there]])]
        while stack:
            ask, node = stack.pop()
            if whole is not None:
                open_ = whole[node] != own[ask]
                ask, node = ask[open_], node[open_]
            if len(ask) > FRONT:
                half = len(ask) // 2
                stack += [(ask[:half], node[:half]), (ask[half:], node[half:])]
                continue
            if not len(ask):
                continue
            self.visited += len(ask)
            far = np.bitwise_count(wanted[ask] ^ self.items[node]).astype(np.int64)
            hit = far <= self.radius
            if hit.any():
                yield ask[hit], node[hit]
            a = np.searchsorted(self.key, node * EDGES + np.maximum(0, far - self.radius))
            size = np.searchsorted(self.key, node * EDGES + np.minimum(EDGES - 1, far + self.radius), "right") - a
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            stack.append((np.repeat(ask, size), self.child[np.repeat(a, size) + step]))
