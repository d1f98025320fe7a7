"""Byte automata that are run in parallel: chunks as maps of states with counts, composed in a tree, searched by descent.

A chunk of a text is summed up by where each state leads and by how many units start and how many marks end on the way.
Two neighbours compose to the same kind of sum, whatever the order in which compositions are done, so all chunks of a text
are summed up at once and pairwise. The tree of sums then leads to the byte where the n-th unit starts: at each node the
left part's count for the state at hand says which way to go.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rows that the table of all groups of bytes may have.
_GROUPS = 1 << 16
UNITS = ("char", "word", "line")


@dataclass(frozen=True)
class Automaton:
    """kind[byte] -> class; for [class, state] the next state, whether a unit starts and whether a mark ends. The last class changes nothing."""

    kind: np.ndarray
    step: np.ndarray
    unit: np.ndarray
    mark: np.ndarray

    @property
    def states(self) -> int:
        return self.step.shape[1]


def _unit_step(unit: str, state: int, byte: int) -> tuple[int, int]:
    """The next state and whether a unit starts: at each code point, at each word between ASCII white space, or at each line."""
    if unit == "char":
        return 0, int(byte & 0xC0 != 0x80)
    if unit == "word":
        space = byte == 32 or 9 <= byte <= 13
        return int(not space), int(not space and state == 0)
    return int(byte != 10), int(state == 0)


def compile_automaton(unit: str = "char", marks: tuple[str, ...] = ()) -> Automaton:
    """Counts the units of UTF-8 texts and the ends of marks in them."""
    if unit not in UNITS:
        raise ValueError(f"units are {', '.join(UNITS)}, not {unit}")
    words = [m.encode() for m in marks if m]
    heads = sorted({w[:i] for w in words for i in range(len(w))} | {b""}, key=lambda h: (len(h), h))

    def mark_step(head: bytes, byte: int) -> tuple[bytes, int]:
        seen = head + bytes([byte])
        rest = next(seen[i:] for i in range(len(seen) + 1) if seen[i:] in heads)
        return rest, int(any(seen.endswith(w) for w in words))

    names = [(h, u) for h in heads for u in range(1 if unit == "char" else 2)]
    at = {name: i for i, name in enumerate(names)}
    table = np.zeros((256, 3, len(names)), np.int64)
    for byte in range(256):
        for i, (head, state) in enumerate(names):
            rest, mark = mark_step(head, byte)
            after, starts = _unit_step(unit, state, byte)
            table[byte, :, i] = at[rest, after], starts, mark
    classes, kind = np.unique(table.reshape(256, -1), axis=0, return_inverse=True)
    classes = classes.reshape(len(classes), 3, len(names))
    same = np.stack([np.arange(len(names)), np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)])
    classes = np.concatenate([classes, same[None]])
    return Automaton(kind.reshape(256).astype(np.int32), *(classes[:, i].astype(np.int32) for i in range(3)))


@dataclass(frozen=True)
class Sums:
    """[node, state]: where the state leads, units that start and marks that end on the way."""

    step: np.ndarray
    unit: np.ndarray
    mark: np.ndarray

    def then(self, other: Sums) -> Sums:
        along = lambda x: np.take_along_axis(x, self.step, axis=1)
        return Sums(along(other.step), self.unit + along(other.unit), self.mark + along(other.mark))

    def take(self, rows: np.ndarray) -> Sums:
        return Sums(self.step[rows], self.unit[rows], self.mark[rows])


def prefixes(own: Sums) -> Sums:
    """The sum of rows 0 to i for each i, by doubling."""
    reach = 1
    while reach < len(own.step):
        both = own.take(np.arange(len(own.step) - reach)).then(own.take(np.arange(reach, len(own.step))))
        own = Sums(*(np.concatenate([a[:reach], b]) for a, b in ((own.step, both.step), (own.unit, both.unit), (own.mark, both.mark))))
        reach *= 2
    return own


class Grouped:
    """An automaton over groups of bytes: as many at once as their table allows."""

    def __init__(self, of: Automaton) -> None:
        self.of, many = of, len(of.step)
        self.size = next(n for n in (4, 2, 1) if many**n <= _GROUPS or n == 1)
        sums = one = Sums(of.step, of.unit, of.mark)
        for _ in range(self.size - 1):
            n = len(sums.step)
            sums = sums.take(np.repeat(np.arange(n), many)).then(one.take(np.tile(np.arange(many), n)))
        self.sums = sums


class Tree:
    """Sums over some texts, which lie one after the other in data, between the given ends."""

    def __init__(self, grouped: Grouped, data: np.ndarray, ends: np.ndarray) -> None:
        self.of, size = grouped.of, grouped.size
        lengths = np.diff(ends, prepend=0)
        many = np.maximum(1, -(-lengths // size))
        first = np.cumsum(many) - many
        self.kinds = np.full(int(many.sum()) * size, len(self.of.step) - 1, np.int32)
        self.kinds[np.arange(len(data)) + np.repeat(first * size - (ends - lengths), lengths)] = self.of.kind[data]
        code = np.zeros(int(many.sum()), np.int64)
        for i in range(size):
            code = code * len(self.of.step) + self.kinds[i::size]
        self.size, self.levels = size, [(first, grouped.sums.take(code))]
        same = Sums(*(x[-1:] for x in (self.of.step, self.of.unit, self.of.mark)))
        while (many > 1).any():
            sums = self.levels[-1][1]
            sums = Sums(*(np.concatenate([x, y]) for x, y in ((sums.step, same.step), (sums.unit, same.unit), (sums.mark, same.mark))))
            half = (many + 1) // 2
            start = np.cumsum(half) - half
            own = np.arange(int(half.sum())) - np.repeat(start, half)
            left = np.repeat(self.levels[-1][0], half) + 2 * own
            right = np.where(2 * own + 1 < np.repeat(many, half), left + 1, len(sums.step) - 1)
            self.levels.append((start, sums.take(left).then(sums.take(right))))
            many = half

    @property
    def roots(self) -> Sums:
        return self.levels[-1][1]

    def find(self, text: np.ndarray, state: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """In each of the texts, entered in the state, the byte where its unit of that number (from 0) starts; there must be so many."""
        at, state, unit = np.zeros(len(text), np.int64), state.copy(), unit.copy()
        for first, sums in reversed(self.levels[:-1]):
            at *= 2
            left = first[text] + at
            before = sums.unit[left, state]
            right = unit >= before
            unit -= np.where(right, before, 0)
            state = np.where(right, sums.step[left, state], state)
            at += right
        found, byte = np.full(len(text), -1, np.int64), (self.levels[0][0][text] + at) * self.size
        for i in range(self.size):
            kind = self.kinds[byte + i]
            starts = self.of.unit[kind, state]
            found = np.where((found < 0) & (starts > 0) & (unit == 0), at * self.size + i, found)
            unit -= starts
            state = self.of.step[kind, state]
        return found
