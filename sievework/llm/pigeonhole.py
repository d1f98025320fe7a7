"""The generalised pigeonhole principle for Hamming distances: which bits go together, and how near each group must be.

If two words of 64 bits differ in at most T bits and the bits are dealt into groups with thresholds t (-1: not used)
so that the sum of t + 1 is T + 1, then in some group they differ in at most its t bits.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np

BITS = 64
#: Cost of a row in the index, and of a candidate pair, for the choice among divisions.
ROW_COST, PAIR_COST = 1.0, 0.0005
MOST_PER_GROUP = 2
#: Words compared at once, so that a bucket takes little memory.
CELLS = 1 << 18


@dataclass(frozen=True)
class Group:
    bits: tuple[int, ...]
    near: int

    def masks(self) -> list[int]:
        """Bits to flip for every value that is near enough, the value itself (0) first."""
        return [sum(1 << b for b in flip) for k in range(self.near + 1) for flip in combinations(self.bits, k)]


def group_bits(together: np.ndarray, many: int) -> list[tuple[int, ...]]:
    """Deal bits into groups of about equal size, each grown from its strongest correlations (together: |correlation|)."""
    left, out = list(range(BITS)), []
    for k in range(many):
        size = -(-len(left) // (many - k))
        own = [max(left, key=lambda i: (together[i, left].sum(), -i))]
        left.remove(own[0])
        while len(own) < size:
            best = max(left, key=lambda i: (together[i, own].mean(), -i))
            left.remove(best)
            own.append(best)
        out.append(tuple(sorted(own)))
    return out


def chance(differ: np.ndarray, most: int) -> float:
    """Probability of at most so many differences among bits that differ independently with these probabilities."""
    p = np.zeros(most + 2)
    p[0] = 1
    for d in differ:
        p[1:] = p[1:] * (1 - d) + p[:-1] * d
        p[0] *= 1 - d
        p[-1] = 0
    return float(p[: most + 1].sum())


def candidates(group: Group, ones: np.ndarray, n: int, sample: np.ndarray) -> float:
    """Words times those probed in their buckets: as in the sample, but no fewer than if bits were independent."""
    share = ones[list(group.bits)]
    masks = group.masks()
    alone = float(n) * n * len(masks) * chance(2 * share * (1 - share), 0)
    if len(sample) < 2:
        return alone
    own = sample & np.uint64(masks_of(group.bits))
    values, sizes = np.unique(own, return_counts=True)
    probed = (own[:, None] ^ np.array(masks, np.uint64)[None, :]).ravel()
    at = np.minimum(np.searchsorted(values, probed), len(values) - 1)
    met = float(sizes[at][values[at] == probed].sum()) - len(sample)  # but each with itself
    return max(alone, met * (n / len(sample)) ** 2)


def masks_of(bits: tuple[int, ...]) -> int:
    return sum(1 << b for b in bits)


def allocate(groups: list[tuple[int, ...]], ones: np.ndarray, n: int, distance: int, sample: np.ndarray) -> tuple[float, tuple[Group, ...]]:
    """Thresholds of least cost by dynamic programming over groups and what is left of distance + 1."""
    best: dict[int, tuple[float, tuple[Group, ...]]] = {0: (0.0, ())}
    for bits in groups:
        costs = [0.0]
        for near in range(min(MOST_PER_GROUP, distance) + 1):
            rows = sum(comb(len(bits), k) for k in range(near + 1))
            costs.append(ROW_COST * n * rows + PAIR_COST * candidates(Group(bits, near), ones, n, sample))
        step: dict[int, tuple[float, tuple[Group, ...]]] = {}
        for used, (cost, chosen) in best.items():
            for near, more in enumerate(costs, -1):
                total = used + near + 1
                if total <= distance + 1 and (total not in step or cost + more < step[total][0]):
                    step[total] = (cost + more, (*chosen, Group(bits, near)) if near >= 0 else chosen)
        best = step
    return best.get(distance + 1, (float("inf"), ()))


def divide(counts: np.ndarray, n: int, distance: int, sample: np.ndarray | None = None) -> tuple[Group, ...]:
    """The cheapest division. counts[i, j]: how many of the n words have both bits; sample: some of the words."""
    some = np.zeros(0, np.uint64) if sample is None else sample
    share = counts / max(n, 1)
    ones = np.diag(share)
    spread = np.sqrt(np.clip(ones * (1 - ones), 1e-9, None))
    together = np.abs(share - np.outer(ones, ones)) / np.outer(spread, spread)
    np.fill_diagonal(together, 0)
    return min((allocate(group_bits(together, many), ones, n, distance, some) for many in range(2, distance + 2)), key=lambda x: x[0])[1]


def near_pairs(words: np.ndarray, own: np.ndarray, distance: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Pairs of at most that distance of which one is among the own words, how many each of these has, and whether the pairs
    are all of them: once there are more than `most`, no more are gathered."""
    x, y, many, degree, mine = [], [], 0, np.zeros(len(words), np.int64), np.flatnonzero(own)
    step = max(1, CELLS // max(len(words), 1))
    for at in range(0, len(mine), step):
        rows = mine[at : at + step]
        near = np.bitwise_count(words[rows, None] ^ words[None, :]) <= distance
        degree[rows] = near.sum(axis=1)
        if many <= most:
            a, b = np.nonzero(near)
            a = rows[a]
            once = (b > a) | ((b < a) & ~own[b])
            x.append(a[once])
            y.append(b[once])
            many += len(x[-1])
    return np.concatenate(x) if x else degree[:0], np.concatenate(y) if y else degree[:0], degree, many <= most


def forest(words: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join what is joined by all links of at most that distance among the words, one fewer than the words at most.

    Each reached word is compared with those not yet reached, so a dense group costs little more than its size.
    """
    out, waiting = [], np.arange(len(words))
    while len(waiting):
        frontier, waiting = [int(waiting[0])], waiting[1:]
        while frontier and len(waiting):
            at = frontier.pop()
            near = np.bitwise_count(words[waiting] ^ words[at]) <= distance
            if near.any():
                reached = waiting[near].tolist()
                out += [(at, x) for x in reached]
                frontier += reached
                waiting = waiting[~near]
    return out
