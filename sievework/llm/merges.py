"""Byte-pair merges as tables: which token comes from which two, and which tokens may stand side by side."""

from __future__ import annotations

import base64

_SHIFT = 20
_NO_BOUND = 1 << 40


class Merges:
    """Tokens numbered by rank. pair maps two tokens to the one that they merge into; left and right undo it (-1: none).

    Two adjacent tokens are compatible if merging the bytes of both, least rank first, ends in just these two. A
    sequence is what the merges give exactly if all its adjacent tokens are compatible, so a text can be encoded by
    looking at neighbours alone. The answers are memoised up to MEMO entries.
    """

    MEMO = 500_000

    def __init__(self, tokens: list[bytes]) -> None:
        if len(tokens) >= 1 << _SHIFT:
            raise ValueError(f"more than {1 << _SHIFT} tokens")
        self.tokens = tokens
        self.length = [len(t) for t in tokens]
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.pair: dict[int, int] = {}
        self.left = [-1] * len(tokens)
        self.right = [-1] * len(tokens)
        self._known: dict[int, bool] = {}

    @classmethod
    def from_ranks(cls, data: bytes) -> Merges:
        """From lines of base64 token and rank. A token's two parts are the split whose halves are compatible among lower ranks."""
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        tokens = sorted(ranks, key=ranks.__getitem__)
        if [ranks[t] for t in tokens] != list(range(len(tokens))):
            raise ValueError("ranks must run from 0 without gaps")
        out = cls(tokens)
        for at, token in enumerate(tokens):
            for cut in range(1, len(token)):
                a, b = out.rank.get(token[:cut], at), out.rank.get(token[cut:], at)
                if a < at and b < at and out._compatible(a, b):
                    out.add(a, b, at)
                    break
        return out

    def add(self, a: int, b: int, merged: int) -> None:
        self.pair[a << _SHIFT | b] = merged
        self.left[merged], self.right[merged] = a, b

    def compatible(self, a: int, b: int) -> bool:
        key = a << _SHIFT | b
        found = self._known.get(key)
        if found is None:
            if len(self._known) >= self.MEMO:
                self._known.clear()
            found = self._known[key] = self._compatible(a, b)
        return found

    def _compatible(self, a: int, b: int) -> bool:
        """Undo merges, latest first, on both sides of the border; a pair across it that would have come earlier breaks it."""
        bound = _NO_BOUND
        while True:
            if self.pair.get(a << _SHIFT | b, _NO_BOUND) < bound:
                return False
            inner_a, inner_b = self.right[a], self.left[b]
            if inner_a < 0 and inner_b < 0:
                return True
            if inner_b < 0 or (inner_a >= 0 and a > b):
                bound, a = a, inner_a
            else:
                bound, b = b + 1, inner_b
