"""Cover trees over unit vectors, and the pairs of two trees that are no farther apart than a threshold.

A node holds a range of points, the first of which is its centre, and how far the farthest of them lies from it. Its
children are a net of at most half its level's radius: no child's centre lies in the ball of another before it, and the
first child has its parent's centre. Two trees are walked together: a pair of nodes whose balls are too far apart is left,
one whose farthest points are near enough is counted as a whole, and the others are opened.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Points up to which a node isn't divided.
LEAF = 32
#: What rounding may do to a distance.
CLOSE = 1e-9
#: Distances worked on at once.
_CELLS = 1 << 21
#: Links after which they are reduced to components.
_LINKS = 1 << 20


def _apart(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


def _net(points: np.ndarray, radius: float) -> np.ndarray:
    """For each point the first centre within the radius, where every point that has none before it becomes a centre."""
    owner, least = np.full(len(points), -1), 1 - radius * radius / 2
    free = np.ones(len(points), bool)
    step = max(1, min(256, _CELLS // max(1, len(points))))
    for start in range(0, len(points), step):
        centres = np.flatnonzero(free[start : start + step]) + start
        near = points[centres] @ points.T >= least if len(centres) else None
        for row, centre in enumerate(centres.tolist()):
            if free[centre]:
                mine = near[row] & free
                mine[centre] = True
                free &= ~mine
                owner[mine] = centre
    return owner


@dataclass
class CoverTree:
    """order: the points' places before; nodes [start, end, radius, first child, children]: the root is the first, a leaf has none."""

    order: np.ndarray
    nodes: np.ndarray

    @classmethod
    def over(cls, points: np.ndarray) -> CoverTree:
        order, nodes = np.arange(len(points)), []
        centre = _apart(points @ points[0]).max(initial=0) if len(points) else 0.0
        nodes.append([0, len(points), float(centre), 0, 0])
        at = 0
        while at < len(nodes):
            start, end, radius = int(nodes[at][0]), int(nodes[at][1]), nodes[at][2]
            if end - start > LEAF and radius > CLOSE:
                half = 2.0 ** math.ceil(math.log2(radius)) / 2
                own = order[start:end]
                owner = _net(points[own], half)
                inner = np.argsort(owner, kind="stable")
                order[start:end] = own[inner]
                cuts = np.flatnonzero(np.diff(owner[inner], prepend=-1))
                sizes = np.diff(cuts, append=end - start)
                heads = np.repeat(order[start:end][cuts], sizes)
                far = _apart(np.einsum("ij,ij->i", points[order[start:end]], points[heads]))
                far[cuts] = 0
                nodes[at][3:] = [len(nodes), len(cuts)]
                nodes += [[start + a, start + a + n, r, 0, 0] for a, n, r in zip(cuts.tolist(), sizes.tolist(), np.maximum.reduceat(far, cuts).tolist(), strict=True)]
            at += 1
        return cls(order, np.array(nodes, float))


class Side:
    """A tree with its points in the tree's order, and how many vectors each of them stands for."""

    def __init__(self, points: np.ndarray, weights: np.ndarray, nodes: np.ndarray) -> None:
        self.points, self.weights = points, weights.astype(np.int64)
        self.start, self.end, self.first, self.many = (nodes[:, i].astype(np.int64) for i in (0, 1, 3, 4))
        self.radius = nodes[:, 2]
        self.before = np.concatenate([[0], np.cumsum(weights)])

    def open(self, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """start, end, radius and number of a node's children, or of its points; the point at i has number -1 - i and is its own child."""
        if node >= 0 and self.many[node]:
            own = np.arange(self.first[node], self.first[node] + self.many[node])
            single = self.end[own] - self.start[own] == 1
            return self.start[own], self.end[own], self.radius[own], np.where(single, -1 - self.start[own], own)
        own = np.arange(self.start[node], self.end[node]) if node >= 0 else np.array([-1 - node])
        return own, own + 1, np.zeros(len(own)), -1 - own


class Joined:
    """What the walk over one tree, or two, finds: links of each point (by weight) and components of all points together."""

    def __init__(self, a: Side, b: Side | None, least: float) -> None:
        self.a, self.b, self.least, self.far = a, b or a, least, math.sqrt(max(2 - 2 * least, 0))
        self.same = b is None
        self.shift = 0 if self.same else len(a.points)
        n = len(a.points) + (0 if self.same else len(self.b.points))
        self.change, self.extra, self.label = np.zeros(n + 1, np.int64), np.zeros(n, np.int64), np.arange(n)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.whole: set[tuple[int, int]] = set()
        self.measured = 0
        self._walk()
        self._reduce()
        self.links = np.cumsum(self.change[:-1]) + self.extra

    def _reduce(self) -> None:
        if not self.held:
            return
        x, y = (np.concatenate(z) for z in zip(*self.held, strict=True))
        self.held.clear()
        while True:
            p, q = self.label[x], self.label[y]
            if (p == q).all():
                return
            np.minimum.at(self.label, np.maximum(p, q), np.minimum(p, q))
            while (self.label != self.label[self.label]).any():
                self.label = self.label[self.label]

    def _link(self, x: np.ndarray, y: np.ndarray) -> None:
        self.held.append((x, y))
        if sum(len(p) for p, _ in self.held) > _LINKS:
            self._reduce()

    def _unite(self, start: int, end: int) -> None:
        if end - start > 1 and (start, end) not in self.whole:
            self.whole.add((start, end))
            self._link(np.full(end - start - 1, start), np.arange(start + 1, end))

    def _all(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        """Every point of the one range is linked with every one of the other; a range with itself: each with the others."""
        of_a, of_b = (int(s.before[r[1]] - s.before[r[0]]) for s, r in ((self.a, a), (self.b, b)))
        i, j = a, (b[0] + self.shift, b[1] + self.shift)
        self._unite(*i)
        self.change[i[0]] += of_b
        self.change[i[1]] -= of_b
        if i == j:
            self.extra[i[0] : i[1]] -= self.a.weights[i[0] : i[1]]
            return
        self._unite(*j)
        self.change[j[0]] += of_a
        self.change[j[1]] -= of_a
        self._link(np.array([i[0]]), np.array([j[0]]))

    def _points(self, x: np.ndarray, y: np.ndarray, dots: np.ndarray) -> None:
        """Pairs of points by their cosine; where it is too close to tell, with products added up without rounding."""
        good = dots >= self.least
        for k in np.flatnonzero(np.abs(dots - self.least) < CLOSE).tolist():
            p, q = self.a.points[x[k]], self.b.points[y[k]]
            good[k] = math.fsum(p * q) / math.sqrt(math.fsum(p * p) * math.fsum(q * q)) >= self.least
        x, y = x[good], y[good]
        np.add.at(self.extra, x, self.b.weights[y])
        np.add.at(self.extra, y + self.shift, self.a.weights[x])
        self._link(x, y + self.shift)

    def _pairs(self, a: int, b: int) -> Iterator[tuple[tuple, tuple, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Children of two nodes that neither are too far apart nor counted yet: both sides, their rows and columns, dots, distances."""
        left, right = self.a.open(a), self.b.open(b)
        centres = self.b.points[right[0]]
        step = max(1, _CELLS // max(1, len(centres)))
        for row in range(0, len(left[0]), step):
            cut = row if self.same and a == b else 0
            dots = self.a.points[left[0][row : row + step]] @ centres[cut:].T
            self.measured += dots.size
            apart = _apart(dots)
            near = apart - left[2][row : row + step, None] - right[2][cut:] <= self.far + CLOSE
            if self.same and a == b:
                near &= left[0][row : row + step, None] < right[0][cut:]
            x, y = np.nonzero(near)
            yield left, right, x + row, y + cut, dots[x, y], apart[x, y]

    def _walk(self) -> None:
        stack = [(0, 0)] if len(self.a.points) and len(self.b.points) else []
        while stack:
            a, b = stack.pop()
            if self.same and a == b:
                if 2 * self.a.radius[a] <= self.far - CLOSE:
                    self._all((int(self.a.start[a]), int(self.a.end[a])), (int(self.a.start[a]), int(self.a.end[a])))
                    continue
                stack += [(int(c), int(c)) for c in self.a.open(a)[3] if c >= 0]
            for left, right, x, y, dots, apart in self._pairs(a, b):
                near = apart + left[2][x] + right[2][y] <= self.far - CLOSE
                point = (left[3][x] < 0) & (right[3][y] < 0)
                if point.any():
                    self._points(left[0][x[point]], right[0][y[point]], dots[point])
                for p, q in zip(x[near & ~point].tolist(), y[near & ~point].tolist(), strict=True):
                    self._all((int(left[0][p]), int(left[1][p])), (int(right[0][q]), int(right[1][q])))
                stack += zip(left[3][x[~near & ~point]].tolist(), right[3][y[~near & ~point]].tolist(), strict=True)
