"""Multiway hyperplane tree with distance ranges (GNAT) for exact searches by inner product.

Whole-number vectors get one more component, x' = (x, sqrt(M2 - |x|^2)) with M2 the largest squared length of all; a
query gets zero there. Then |q' - x'|^2 = |q|^2 + M2 - 2 q.x, so a window of scores is an annulus around the query, and
Euclidean bounds hold for inner products, exactly and in the same order.

A node has a few split points; a row belongs to the nearest one. Each split point stores the least and largest distance
from it to the rows of each sibling's subtree. A query measures its distance to the split points of a node and drops
every sibling whose ranges leave no place for the query's annuli. What is left at the leaves is scored exactly.

Split points come from a bounded sample; every row is indexed, and ranges are taken over all rows. The tree has at most
`leaves` leaves of `width` ranges a node, and that is what the driver holds and broadcasts. Distances decide nothing but
what may be dropped, and are widened by more than their rounding.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

NONE = -(1 << 62)  # lower end of a window that is open


@dataclass
class Node:
    points: np.ndarray  # split points, one row each
    children: list[int]  # node number, or -1 - leaf
    low: np.ndarray = field(default=None)  # low[i, j]: least distance from split point i to the rows below child j
    high: np.ndarray = field(default=None)


class Tree:
    """Nodes of the tree, root first; `m2` bounds the squared length of every row."""

    def __init__(self, m2: int) -> None:
        self.m2, self.nodes, self.leaves = m2, [], 0
        self.slack = 1e-6 * (np.sqrt(float(m2)) + 1.0)

    def distances(self, x: np.ndarray, points: np.ndarray, *, query: bool) -> np.ndarray:
        """Distances between rows of `x` and split points in the lifted space; a query is not lifted."""
        squares, others = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", points, points)
        up = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.m2 - squares, 0.0))
        over = np.sqrt(np.maximum(self.m2 - others, 0.0))
        return np.sqrt(np.maximum(squares[:, None] + others[None] - 2 * (x @ points.T) + (up[:, None] - over[None]) ** 2, 0.0))

    def grow(self, sample: np.ndarray, width: int, depth: int) -> int:
        """Add the subtree over `sample` and return its number; a leaf where there is nothing left to split."""
        sample = np.unique(sample, axis=0)
        points = self._spread(sample, width) if depth and len(sample) > 1 else sample[:0]
        if len(points) < 2:
            self.leaves += 1
            return -self.leaves
        at = len(self.nodes)
        node = Node(points, [])
        self.nodes.append(node)
        own = self.distances(sample, points, query=False).argmin(axis=1)
        node.children = [self.grow(sample[own == j], width, depth - 1) for j in range(len(points))]
        shape = (len(points), len(points))
        node.low, node.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        return at

    def _spread(self, sample: np.ndarray, width: int) -> np.ndarray:
        """Split points far apart, out of at most 64 candidates a point that lie at even steps of the sample."""
        candidates = sample[np.linspace(0, len(sample) - 1, min(len(sample), 64 * width)).astype(int)]
        candidates = np.unique(candidates, axis=0)
        chosen = [0]
        far = self.distances(candidates, candidates[:1], query=False)[:, 0]
        while len(chosen) < width and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, self.distances(candidates, candidates[chosen[-1:]], query=False)[:, 0])
        return candidates[chosen]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Leaf of each row, and for each node met the ranges of distances that these rows add."""
        leaf, ranges = np.zeros(len(x), np.int32), {}
        front = [(0, np.arange(len(x)))] if self.nodes and len(x) else []
        while front:
            at, rows = front.pop()
            node = self.nodes[at]
            d = self.distances(x[rows], node.points, query=False)
            own = d.argmin(axis=1)
            low, high = np.full(node.low.shape, np.inf), np.full(node.low.shape, -np.inf)
            for j in np.unique(own):
                below = own == j
                low[:, j], high[:, j] = d[below].min(axis=0), d[below].max(axis=0)
                if node.children[j] < 0:
                    leaf[rows[below]] = -1 - node.children[j]
                else:
                    front.append((node.children[j], rows[below]))
            ranges[at] = (low, high)
        return leaf, ranges

    def reach(self, x: np.ndarray, owner: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) pairs that may hold a row scoring within `least`..`most` of a window.

        `x` are the queries; window w belongs to query owner[w]. A subtree is left out only if no window reaches it.
        """
        if not self.nodes:
            return np.arange(len(x)), np.zeros(len(x), np.int32)
        far = np.einsum("ij,ij->i", x, x)[owner] + self.m2
        inner = np.sqrt(np.maximum(far - 2.0 * most, 0.0)) - self.slack
        outer = np.where(least == NONE, np.inf, np.sqrt(np.maximum(far - 2.0 * least, 0.0)) + self.slack)
        alive = (least <= most) & (far - 2.0 * least + self.slack >= 0)  # a score beyond all lengths is out of reach
        found, front = [], [(0, np.flatnonzero(alive))]
        while front:
            at, windows = front.pop()
            node = self.nodes[at]
            d = self.distances(x[owner[windows]], node.points, query=True)[:, :, None]
            nearest = np.maximum(d - node.high, node.low - d).max(axis=1)
            farthest = (d + node.high).min(axis=1)
            for j, child in enumerate(node.children):
                if node.high[j, j] < 0:
                    continue  # no row is below
                left = windows[(nearest[:, j] <= outer[windows]) & (farthest[:, j] >= inner[windows])]
                if len(left) and child < 0:
                    found.append((owner[left], -1 - child))
                elif len(left):
                    front.append((child, left))
        pairs = [(q, leaf) for queries, leaf in found for q in np.unique(queries)]
        both = np.array(pairs, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1].astype(np.int32)


def best(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, own: np.ndarray, owner: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, *, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, row, score) of the k best rows of a leaf in each window, among rows of the query's label or all others.

    Rows must be in order of `ids`; of equal scores the smaller id comes first. Inputs are whole numbers kept as
    doubles, with all scores below 2^50, so products and sums are exact.
    """
    scores = (queries @ x.T).astype(np.int64)
    mates = labels[None] == own[:, None]
    fits = mates if same else ~mates
    n = len(x)
    keyed = np.where(fits, scores * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
    out = []
    for low in range(0, len(owner), 256):
        part = slice(low, low + 256)
        s = scores[owner[part]]
        keys = np.where((s >= least[part, None]) & (s <= most[part, None]), keyed[owner[part]], np.iinfo(np.int64).min)
        if n > k:
            at = np.argpartition(keys, n - k, axis=1)[:, n - k :]
        else:
            at = np.tile(np.arange(n), (len(keys), 1))
        window, column = np.nonzero(np.take_along_axis(keys, at, axis=1) != np.iinfo(np.int64).min)
        row = at[window, column]
        out.append((window + low, row, s[window, row]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
