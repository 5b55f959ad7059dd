"""A cover tree over a block of integer vectors whose inner products with queries are searched.

Candidates get one more component, so that all have the norm M of the longest; with a query
scaled to M and a 0 in that place, a larger inner product is a shorter distance. A node has a
centre (one of its points), a covering radius and its children's centres, which are more than
half its radius apart and cover its points within half of it. From the distance D of the query
to a centre and the radius r follow bounds on all inner products below the node.

The search goes down best first: of the open nodes those with the highest bounds are opened, in
steps of ``STEP``. Nodes whose bounds miss every window, or stay below the kth score found in
it, are skipped; points of leaves are compared exactly, as integers.
"""

from __future__ import annotations

import numpy as np

LEAF = 8
STEP = 64
# Rounding of bounds, as a part of |q| M; they only decide what is looked at.
SLACK = 1e-6
EXACT = float(1 << 53)


def products(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point while that is exact."""
    if not points.size or not query.size:
        return np.zeros(points.shape[:1] + query.shape[1:], dtype=np.int64)
    most = float(np.abs(points).max()) * float(np.abs(query).max()) * points.shape[1]
    if most < EXACT:
        return (points.astype(float) @ query.astype(float)).astype(np.int64)
    return points @ query


class CoverTree:
    """Nodes as arrays: centre, radius, range of points, range of children (none: a leaf)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        norms = np.einsum("ij,ij->i", points.astype(float), points.astype(float))
        self.reach = float(np.sqrt(norms.max(initial=0.0)))
        last = np.sqrt(np.maximum(self.reach**2 - norms, 0.0))
        apart = norms[:, None] + norms[None, :] - 2.0 * products(points, points.T).astype(float)
        apart = np.sqrt(np.maximum(apart + (last[:, None] - last[None, :]) ** 2, 0.0))
        order: list[np.ndarray] = []
        nodes: list[list[float]] = []  # centre, radius, first child, children
        members: list[np.ndarray] = [np.arange(len(ids))]
        nodes.append([0, float(apart[0].max(initial=0.0)), 0, 0])
        at = 0
        while at < len(nodes):
            centre, radius, _, _ = nodes[at]
            mine = members[at]
            if len(mine) > LEAF and radius > 0:
                nodes[at][2] = len(nodes)
                for middle, near in _cover(apart, int(centre), mine, radius / 2):
                    nodes.append([middle, float(apart[middle, near].max()), 0, 0])
                    members.append(near)
                nodes[at][3] = len(nodes) - nodes[at][2]
            at += 1
        self.centre = np.array([n[0] for n in nodes], dtype=np.int64)
        self.radius = np.array([n[1] for n in nodes]) * (1 + 1e-9)
        self.child = np.array([n[2] for n in nodes], dtype=np.int64)
        self.children = np.array([n[3] for n in nodes], dtype=np.int64)
        # Points of leaves, one leaf after the other.
        self.low = np.zeros(len(nodes), dtype=np.int64)
        self.high = np.zeros(len(nodes), dtype=np.int64)
        placed = 0
        for node, (mine, n) in enumerate(zip(members, nodes)):
            if not n[3]:
                order.append(mine)
                self.low[node], placed = placed, placed + len(mine)
                self.high[node] = placed
        order = np.concatenate(order) if order else np.empty(0, np.int64)
        back = np.empty(len(ids), dtype=np.int64)
        back[order] = np.arange(len(order))
        self.centre = back[self.centre]
        self.ids, self.points = ids[order], points[order]

    NAMES = ("centre", "radius", "child", "children", "low", "high", "ids")

    def packed(self) -> dict[str, bytes]:
        """The arrays as bytes; points with as few bytes each as the largest value needs."""
        out = {name: getattr(self, name).tobytes() for name in self.NAMES}
        return out | {"points": narrow(self.points), "reach": self.reach}

    @classmethod
    def unpacked(cls, held: dict, dims: int) -> CoverTree:
        tree = cls.__new__(cls)
        for name in cls.NAMES:
            setattr(tree, name, np.frombuffer(held[name], "<f8" if name == "radius" else "<i8"))
        tree.points, tree.reach = wide(held["points"], len(tree.ids), dims), held["reach"]
        return tree

    def _bounds(self, nodes: np.ndarray, query: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds on the inner products of the query below nodes."""
        score = products(self.points[self.centre[nodes]], query).astype(float)
        radius, most = self.radius[nodes], self.reach
        upper, lower = score + norm * radius, score - norm * radius
        if norm and most:
            scale = most / norm
            far = np.sqrt(np.maximum(2 * most * most - 2 * scale * score, 0.0))
            close = (most * most - np.maximum(far - radius, 0.0) ** 2 / 2) / scale
            distant = (most * most - (far + radius) ** 2 / 2) / scale
            upper = np.where(radius > 0, np.minimum(upper, close), upper)
            lower = np.where(radius > 0, np.maximum(lower, distant), lower)
        slack = np.where(radius > 0, SLACK * (norm * most + 1), 0.0)  # exact at single points
        return upper + slack, lower - slack

    def search(self, query: np.ndarray, own: int, windows: list[Window]) -> int:
        """Take this tree's points (without the id ``own``) into windows; how many were compared."""
        norm = float(np.sqrt((query.astype(float) ** 2).sum()))
        nodes = np.zeros(1 if len(self.ids) else 0, dtype=np.int64)
        upper, lower = self._bounds(nodes, query, norm)
        compared = 0
        while len(nodes):
            needed = np.zeros(len(nodes), dtype=bool)
            for window in windows:
                needed |= (upper >= window.least()) & (lower <= window.high)
            nodes, upper, lower = nodes[needed], upper[needed], lower[needed]
            order = np.argsort(-upper, kind="stable")
            now, later = nodes[order[:STEP]], order[STEP:]
            nodes, upper, lower = nodes[later], upper[later], lower[later]
            leaf = self.children[now] == 0
            points = _ranges(self.low[now[leaf]], self.high[now[leaf]])
            points = points[self.ids[points] != own]
            compared += len(points)
            if len(points):
                scores = products(self.points[points], query)
                for window in windows:
                    window.offer(self.ids[points], scores)
            first = self.child[now[~leaf]]
            below = _ranges(first, first + self.children[now[~leaf]])
            if len(below):
                up, down = self._bounds(below, query, norm)
                nodes = np.concatenate([nodes, below])
                upper, lower = np.concatenate([upper, up]), np.concatenate([lower, down])
        return compared


class Window:
    """The k best scores from ``low`` to ``high``: higher first, ties by the smaller id."""

    def __init__(self, low: float, high: float, k: int):
        self.low, self.high, self.k = low, high, k
        self.ids = np.empty(0, dtype=np.int64)
        self.scores = np.empty(0, dtype=np.int64)

    def least(self) -> float:
        """What a score must reach to change anything."""
        if self.low > self.high:
            return np.inf
        return max(self.low, self.scores[-1]) if len(self.scores) == self.k else self.low

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = (scores >= self.least()) & (scores <= self.high)
        if fit.any():
            ids = np.concatenate([self.ids, ids[fit]])
            scores = np.concatenate([self.scores, scores[fit]])
            order = np.lexsort((ids, -scores))[: self.k]
            self.ids, self.scores = ids[order], scores[order]


def _cover(apart: np.ndarray, centre: int, members: np.ndarray, radius: float):
    """Centres more than ``radius`` apart, the node's own first, and the members each covers."""
    rest, middle = members, centre
    while len(rest):
        near = apart[middle, rest] <= radius
        yield middle, rest[near]
        rest = rest[~near]
        middle = int(rest[0]) if len(rest) else -1


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges low..high, one range after the other."""
    many = high - low
    return np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())


def narrow(values: np.ndarray) -> bytes:
    """Integers with 1, 2, 4 or 8 bytes each, as the largest needs."""
    for kind in ("<i1", "<i2", "<i4"):
        if values.size and np.iinfo(kind).min <= values.min() and values.max() <= np.iinfo(kind).max:
            return values.astype(kind).tobytes()
    return values.astype("<i8").tobytes()


def wide(packed: bytes, rows: int, dims: int) -> np.ndarray:
    kind = f"<i{len(packed) // (rows * dims)}" if rows * dims else "<i8"
    return np.frombuffer(packed, kind).reshape(rows, dims).astype(np.int64)
