"""Boolean trigram queries: what a text must contain for a regular expression to match it."""

from __future__ import annotations

import re._constants as kinds  # type: ignore[import-not-found]
import re._parser as parser  # type: ignore[import-not-found]
from itertools import product

#: A query is True (nothing is known), a trigram (bytes), or ("and" | "or", frozenset of queries).
Query = bool | bytes | tuple
#: Strings that a set of alternatives may hold before it is turned into a query.
MOST = 24


def _join(kind: str, parts: list[Query]) -> Query:
    if kind == "and":
        parts = [p for p in parts if p is not True]
        if not parts:
            return True
    elif any(p is True for p in parts):
        return True
    flat = frozenset(q for p in parts for q in (p[1] if isinstance(p, tuple) and p[0] == kind else (p,)))
    return next(iter(flat)) if len(flat) == 1 else (kind, flat)


def _of_strings(strings: set[bytes]) -> Query:
    if not strings:
        return True
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _fold(char: int) -> bytes:
    return chr(char).encode().lower()


def _item(op: object, arg: object) -> tuple[set[bytes] | None, Query]:
    """The strings that the item matches exactly (None: too many) and a query that holds whenever it matches."""
    if op is kinds.LITERAL:
        return {_fold(arg)}, True
    if op is kinds.IN:
        found: set[bytes] = set()
        for kind, value in arg:
            if kind is kinds.LITERAL:
                found.add(_fold(value))
            elif kind is kinds.RANGE and value[1] - value[0] < MOST:
                found |= {_fold(c) for c in range(value[0], value[1] + 1)}
            else:
                return None, True
        return (found, True) if len(found) <= 6 else (None, True)
    if op is kinds.SUBPATTERN:
        return _sequence(arg[3])
    if op is kinds.ATOMIC_GROUP:
        return _sequence(arg)
    if op is kinds.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in parts) and len(whole := set().union(*(s for s, _ in parts))) <= MOST:
            return whole, True
        return None, _join("or", [_join("and", [q, _of_strings(s or set())]) for s, q in parts])
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        least, most, what = arg
        strings, query = _sequence(what)
        if strings is not None and most == 1:
            return (strings | {b""} if least == 0 else strings), True
        if strings is not None and least == most and len(strings) ** least <= MOST:
            return {b"".join(x) for x in product(strings, repeat=least)}, True
        return None, (_join("and", [query, _of_strings(strings or set())]) if least else True)
    if op in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
        return {b""}, True
    return None, True


def _sequence(items: object) -> tuple[set[bytes] | None, Query]:
    """Neighbouring exact items are multiplied out, so that trigrams across their borders count."""
    exact, held, queries = True, {b""}, []
    for op, arg in items:
        strings, query = _item(op, arg)
        queries.append(query)
        if strings is not None and len(held) * len(strings) <= MOST:
            held = {a + b for a in held for b in strings}
            continue
        queries.append(_of_strings(held))
        exact, held = False, {b""}
        if strings is not None:
            held = strings
    if exact:
        return held, _join("and", queries)
    return None, _join("and", [*queries, _of_strings(held)])


def query(pattern: str, flags: int = 0) -> Query:
    """The query of a pattern, over lower-cased bytes."""
    strings, found = _sequence(parser.parse(pattern, flags))
    return found if strings is None else _join("and", [found, _of_strings(strings)])


def mentioned(q: Query) -> set[bytes]:
    return {q} if isinstance(q, bytes) else set() if q is True else set().union(*map(mentioned, q[1]))
