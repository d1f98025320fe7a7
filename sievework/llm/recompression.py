"""Repeated passages by recompression in Spark rounds.

A round renames the token sequences of all documents at once: each run of a symbol becomes one symbol, and so do
neighbours of which a bit of their names makes the first a left and the second a right one. Tasks propose a name for
each new symbol, and one aggregation over all documents makes the round's dictionary: what each name stands for and
whether several documents have it. A name proposed for two things makes the round start again with other names, so
equal symbols stand for equal words. Which names several documents share is what the next round gets to know.

Whether a symbol is where it is depends on few words: [lo, hi) around it are tracked. If a window of words holds all of
them the symbol is proper to the window, and every equal window has an equal proper symbol at the same place. A window
with a proper symbol that one document alone has can't be in another, so after the first round the corpus shrinks to
segments of windows that are still alive, and on with every round.

After the last round each window is filed under the highest proper symbol it has (the least name of these).
Windows next to each other that are filed alike make a context, known by name and a hash of its words. Contexts that
several documents share settle all their windows at once; where one symbol has several contexts, windows are looked at
one by one in the first document of each, at every place where it has that context. What is found this way is joined
to whole passages, and the words of each are compared with those of the document where it stood first.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_one
from ..session import small_side, stash
from .blocks import map_blocks

WINDOW, ROUNDS = 50, 5
#: A round's shared names are sent on as a bitmap: bits for each name, and the most bits (as powers of two). More names
#: than fit only let more windows through to the next round.
FILTER_SHARE, FILTER_BITS = 5, 28
#: Documents with repeats up to which their keys are broadcast to pick out texts; beyond, all texts are shuffled.
BROADCAST_ROWS = 1_000_000
#: Seeds that a round tries before it fails.
TRIES = 4
_FAR = 1 << 60
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0x27D4EB2F165667C5))
_BASE = 0xD1342543DE82EF95


def _mix(x: np.ndarray, y: np.ndarray | np.uint64, seed: int = 0) -> np.ndarray:
    """For a given x and seed no two y have the same value."""
    with np.errstate(over="ignore"):
        z = x * _A + y * _B + np.uint64(seed) * _D
    z ^= z >> np.uint64(29)
    z *= _C
    z ^= z >> np.uint64(32)
    return z


class Powers:
    """Powers of the base and of its inverse modulo 2^64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
            ones = np.ones(n + n // 4 + 1, np.uint64)
            self.up, self.down = ones.copy(), ones
            self.up[1:], self.down[1:] = base, inverse
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up, self.down


class Filter:
    """A bitmap of the leading bits of names."""

    def __init__(self, bits: int, data: np.ndarray) -> None:
        self.bits, self.data = bits, data

    def has(self, names: np.ndarray) -> np.ndarray:
        at = names >> np.uint64(64 - self.bits)
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Round:
    """What later rounds need of one that is done: its seed and the names that several documents share."""

    def __init__(self, seed: int, shared: Filter | None) -> None:
        self.seed, self.shared = seed, shared


class Births:
    """Symbols that a round made: name, what the name was made of, first word, the words [lo, hi) that they depend on."""

    def __init__(self, names: np.ndarray, left: np.ndarray, start: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        self.names, self.left, self.start, self.lo, self.hi = names, left, start, lo, hi

    def where(self, chosen: np.ndarray) -> Births:
        return Births(self.names[chosen], self.left[chosen], self.start[chosen], self.lo[chosen], self.hi[chosen])

    def plus(self, other: Births) -> Births:
        return Births(*(np.concatenate([getattr(self, k), getattr(other, k)]) for k in ("names", "left", "start", "lo", "hi")))


class Parse:
    """Symbols and living windows of a block of documents, given as the hashes of their words, one document after the other."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, window: int) -> None:
        self.hashes, self.window, self.total = hashes, window, len(hashes)
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self.begin = np.cumsum(counts) - counts
        at = np.arange(self.total)
        self.alive = at + window <= np.repeat(self.begin + counts, counts)
        self.names, self.start, self.lo, self.hi = hashes, at, at, at + 1
        self.levels: list[Births] = []

    def _beside(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """lo and hi of the neighbours on the left, then on the right; beyond a document's end lies no window."""
        n, doc = len(self.names), self.owner[self.start]
        same = doc[1:] == doc[:-1]
        out = []
        for values, far in ((self.lo, -_FAR), (self.hi, -_FAR), (self.lo, _FAR), (self.hi, _FAR)):
            x = np.full(n, far)
            if len(out) < 2:
                x[1:] = np.where(same, values[:-1], -_FAR)
            else:
                x[:-1] = np.where(same, values[1:], _FAR)
            out.append(x)
        return out[0], out[1], out[2], out[3]

    def _runs(self, seed: int) -> Births:
        n = len(self.names)
        doc = self.owner[self.start]
        first = np.ones(n, bool)
        first[1:] = (doc[1:] != doc[:-1]) | (self.names[1:] != self.names[:-1])
        at = np.flatnonzero(first)
        length = np.diff(at, append=n)
        last = at + length - 1
        lo_left, _, _, hi_right = self._beside()
        lo = np.minimum(np.minimum.reduceat(self.lo, at), lo_left[at]) if n else self.lo
        hi = np.maximum(np.maximum.reduceat(self.hi, at), hi_right[last]) if n else self.hi
        many, left = length > 1, self.names[at]
        self.names = np.where(many, _mix(left, ~length.astype(np.uint64), seed), left)
        self.start, self.lo, self.hi = self.start[at], lo, hi
        return Births(self.names, left, self.start, lo, hi).where(many)

    def _pairs(self, seed: int) -> Births:
        n = len(self.names)
        doc = self.owner[self.start]
        right = (_mix(self.names, np.uint64(77), seed) >> np.uint64(63)).astype(bool)
        lo_left, hi_left, lo_right, hi_right = self._beside()
        lo = np.minimum(self.lo, np.where(right, lo_left, lo_right))
        hi = np.maximum(self.hi, np.where(right, hi_left, hi_right))
        pair = np.flatnonzero(~right[:-1] & right[1:] & (doc[1:] == doc[:-1])) if n else np.zeros(0, np.int64)
        left = self.names[pair]
        names = self.names.copy()
        names[pair] = _mix(left, self.names[pair + 1], seed)
        lo[pair] = np.minimum(self.lo[pair], self.lo[pair + 1])
        hi[pair] = np.maximum(self.hi[pair], self.hi[pair + 1])
        born = Births(names[pair], left, self.start[pair], lo[pair], hi[pair])
        keep = np.ones(n, bool)
        keep[pair + 1] = False
        self.names, self.start, self.lo, self.hi = names[keep], self.start[keep], lo[keep], hi[keep]
        return born

    def round(self, seed: int) -> Births:
        """The new symbols that are proper to living windows. Runs are named in the first round; later ones would widen [lo, hi)."""
        born = self._pairs(seed) if self.levels else self._runs(seed).plus(self._pairs(seed))
        return born.where(self.proper(born, self.alive))

    def proper(self, born: Births, windows: np.ndarray) -> np.ndarray:
        """Is a symbol proper to any of these windows?"""
        before = np.concatenate([[0], np.cumsum(windows)])
        a, b = np.clip(born.hi - self.window, 0, self.total), np.clip(born.lo + 1, 0, self.total)
        return (b > a) & (before[np.maximum(a, b)] > before[a])

    def know(self, born: Births, shared: Filter) -> None:
        """Windows with a proper symbol that isn't shared die."""
        known = shared.has(born.names)
        dead = born.where(~known)
        kill = np.zeros(self.total + 1, np.int64)
        np.add.at(kill, np.clip(dead.hi - self.window, 0, self.total), 1)
        np.add.at(kill, dead.lo + 1, -1)
        self.alive &= np.cumsum(kill)[:-1] <= 0
        self.levels.append(born.where(known))

    def chosen(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each living window: its first word, and name and level of the symbol under which it is filed."""
        at = np.arange(self.total)
        name, level = np.zeros(self.total, np.uint64), np.full(self.total, -1)
        open_ = self.alive.copy()
        words = Births(self.hashes, self.hashes, at, at, at + 1)
        for number, born in [*reversed(list(enumerate(self.levels, 1))), (0, words)]:
            born = born.where(self.proper(born, open_))
            born = born.where(np.argsort(born.names)[::-1])  # of several put in one place, the last stays
            for step in range(self.window):
                window = born.lo - step
                fits = np.flatnonzero((window >= 0) & (born.hi - self.window <= window))
                fits = fits[open_[window[fits]]]
                w, names = window[fits], born.names[fits]
                better = (level[w] < 0) | (names < name[w])
                w = w[better]
                name[w], level[w] = names[better], number
            open_ &= level < 0
            if not open_.any():
                break
        at = np.flatnonzero(self.alive)
        return at, name[at], level[at]


class Parser:
    def __init__(self, window: int, rounds: list[Round]) -> None:
        self.window, self.rounds, self.powers = window, rounds, Powers()

    def parse(self, words: Words) -> Parse:
        out = Parse(words.hashes, words.counts, self.window)
        for r in self.rounds:
            born = out.round(r.seed)
            if r.shared is not None:
                out.know(born, r.shared)
        return out

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers.upto(len(hashes))[0][: len(hashes)], out=out[1:])
        return out

    def passage(self, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words from a up to b, wherever they stand."""
        return _mix((sums[b] - sums[a]) * self.powers.upto(len(sums))[1][a], (b - a).astype(np.uint64))

    def contexts(self, words: Words) -> tuple[np.ndarray, ...]:
        """document, first window (its first word, from 0 in the document), windows, name, hash of the words of each context."""
        parse = self.parse(words)
        at, name, level = parse.chosen()
        first = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (level[1:] != level[:-1]) | (at[1:] != at[:-1] + 1))) if len(at) else at
        many = np.diff(first, append=len(at))
        word = at[first]
        owner = parse.owner[word]
        return owner, word - parse.begin[owner], many, _mix(name[first], level[first].astype(np.uint64)), self.passage(self.sums(words.hashes), word, word + many + self.window - 1)


_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTE = _mix(np.arange(1, 257).astype(np.uint64), np.uint64(1))


class Words:
    """The words (split at ASCII white space) of a block of texts: their hashes one after the other, and how many each text has."""

    def __init__(self, texts: list[str], powers: Powers) -> None:
        coded = [t.encode() for t in texts]
        self.data = b"\n".join([b"", *coded, b""])
        data = np.frombuffer(self.data, np.uint8)
        space = _SPACE[data]
        self.first = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        self.stop = np.flatnonzero(~space[:-1] & space[1:]) + 1
        up, down = powers.upto(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
        self.hashes = _mix((sums[self.stop] - sums[self.first]) * down[self.first], (self.stop - self.first).astype(np.uint64))
        ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)
        self.counts = np.diff(np.searchsorted(self.first, ends, "right"), prepend=0)

    def text(self, a: int, b: int) -> str:
        """Words a up to b, and what is between them."""
        return self.data[self.first[a] : self.stop[b - 1]].decode()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _kind(rows: DataFrame) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"


def _births(rows: DataFrame, rounds: list[Round], seed: int, window: int) -> DataFrame:
    """name, made_of, doc_id for each symbol that the next round would make."""
    known = rows.sparkSession.sparkContext.broadcast(rounds)

    def make() -> Any:
        parser = Parser(window, known.value)

        def work(ids: list, texts: list[str]) -> list:
            parse = parser.parse(Words(texts, parser.powers))
            born = parse.round(seed)
            return [_signed(born.names), _signed(born.left), pa.array(ids).take(pa.array(parse.owner[born.start]))]

        return work

    return map_blocks(rows.select("doc_id", "text"), make, f"name long, made_of long, {_kind(rows)}")


def _named(rows: DataFrame, rounds: list[Round], window: int) -> tuple[Round, int]:
    """One round over all rows: its seed and shared names, and how many names are shared."""
    for seed in range(TRIES):
        born = _births(rows, rounds, seed + TRIES * len(rounds), window)
        names = born.groupBy("name").agg(F.min("made_of").alias("a"), F.max("made_of").alias("b"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        clash = F.col("a") != F.col("b")
        some = stash(names.where(clash | (F.col("first") < F.col("last"))).select("name", clash.alias("clash")))
        size = some.agg(F.count("*").alias("n"), F.count_if("clash").alias("clashes")).first()
        if not size["clashes"]:
            return Round(seed + TRIES * len(rounds), _filter(some, size["n"])), size["n"]
    raise RuntimeError(f"names of a round clashed with each of {TRIES} seeds")


def _filter(names: DataFrame, many: int) -> Filter:
    bits = min(FILTER_BITS, max(15, math.ceil(math.log2(max(many, 1))) + FILTER_SHARE))
    at = F.shiftrightunsigned("name", 64 - bits) + 1
    data = np.zeros(1 << bits - 3, np.uint8)
    # The bitmap comes in buckets of 4 KB, at most 2^(FILTER_BITS - 15) of them.
    for r in names.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).toLocalIterator():
        data[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return Filter(bits, data)


def _segments(rows: DataFrame, rounds: list[Round], window: int) -> DataFrame:
    """doc_id, hash, seg (its first word in the document), text: the stretches of words that living windows cover."""
    known = rows.sparkSession.sparkContext.broadcast(rounds)

    def make() -> Any:
        parser = Parser(window, known.value)

        def work(ids: list, texts: list[str], hashes: list[int]) -> list:
            words = Words(texts, parser.powers)
            parse = parser.parse(words)
            at = np.flatnonzero(parse.alive)
            owner = parse.owner[at]
            fresh = np.flatnonzero(np.append(True, (at[1:] > at[:-1] + window) | (owner[1:] != owner[:-1]))) if len(at) else at
            last = at[np.append(fresh[1:], len(at)) - 1] + window if len(at) else at
            own = owner[fresh]
            begin = parse.begin[own]
            mine = own.tolist()
            return [[ids[i] for i in mine], [hashes[i] for i in mine], at[fresh] - begin, list(map(words.text, at[fresh].tolist(), last.tolist()))]

        return work

    return map_blocks(rows, make, f"{_kind(rows)}, hash long, seg int, text string")


def _contexts(segments: DataFrame, rounds: list[Round], window: int) -> DataFrame:
    """doc_id, hash, seg, at (in the document), n, name, context for each context of each segment."""
    known = segments.sparkSession.sparkContext.broadcast(rounds)

    def make() -> Any:
        parser = Parser(window, known.value)

        def work(ids: list, texts: list[str], hashes: list[int], segs: list[int]) -> list:
            owner, at, n, name, context = parser.contexts(Words(texts, parser.powers))
            seg = np.array(segs, np.int64)[owner]
            mine = owner.tolist()
            return [[ids[i] for i in mine], [hashes[i] for i in mine], seg, seg + at, n, _signed(name), _signed(context)]

        return work

    return map_blocks(segments.select("doc_id", "text", "hash", "seg"), make, f"{_kind(segments)}, hash long, seg int, at int, n int, name long, context long")


def _windows(segments: DataFrame, rounds: list[Round], window: int) -> DataFrame:
    """From segments with marks (an array of contexts): a row for every window of the marked contexts, at each place where they stand."""
    known = segments.sparkSession.sparkContext.broadcast(rounds)

    def make() -> Any:
        parser = Parser(window, known.value)

        def work(ids: list, texts: list[str], hashes: list[int], segs: list[int], marks: list[list[int]]) -> list:
            words = Words(texts, parser.powers)
            owner, at, n, name, context = parser.contexts(words)
            row = np.repeat(np.arange(len(marks)), [len(m) for m in marks]).astype(np.uint64)
            marked = _mix(np.array([c for m in marks for c in m], np.int64).view(np.uint64), row)
            chosen = np.isin(_mix(context, owner.astype(np.uint64)), marked)
            owner, at, n, name = owner[chosen], at[chosen], n[chosen], name[chosen]
            nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            at, owner, name = np.repeat(at, n) + nth, np.repeat(owner, n), np.repeat(name, n)
            word = at + (np.cumsum(words.counts) - words.counts)[owner]
            found = parser.passage(parser.sums(words.hashes), word, word + window)
            seg, mine = np.array(segs, np.int64)[owner], owner.tolist()
            return [[ids[i] for i in mine], [hashes[i] for i in mine], seg, seg + at, _signed(name), _signed(found)]

        return work

    return map_blocks(segments.select("doc_id", "text", "hash", "seg", "marks"), make, f"{_kind(segments)}, hash long, seg int, at int, name long, window long")


def _rows(docs: DataFrame) -> DataFrame:
    """A row is known by its doc_id and a hash of its text, so texts that share a doc_id are told apart."""
    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("hash"))


def hits(docs: DataFrame, window: int = WINDOW, most_rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """doc_id, hash, at, n, first (doc_id, hash, seg, at): n windows from word `at` on that also stand, from `first` on, in a
    document with a smaller doc_id; and the segments they were found in."""
    rows = _rows(docs)
    done, shared = _named(rows, [], window)
    rounds = [done]
    segments = stash(_segments(rows, rounds, window))
    while shared and len(rounds) < most_rounds:
        done, shared = _named(segments, rounds, window)
        rounds.append(done)
    every = stash(_contexts(segments, rounds, window))
    place = F.struct("doc_id", "hash", "seg", "at")
    first = stash(every.groupBy("name", "context").agg(F.min(place).alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("rows")))
    met = join_one(every, first.where(F.col("first.doc_id") < F.col("last")).select("name", "context", "first", "rows"), ["name", "context"])
    settled = met.where(F.col("doc_id") > F.col("first.doc_id")).select("doc_id", "hash", "at", "n", "first")
    # A window of one context may also be in another of the same name whose first document is a smaller one.
    owner = F.col("first.doc_id")
    mixed = stash(first.groupBy("name").agg(F.min(owner).alias("least"), F.max(owner).alias("most"), F.count("*").alias("rows")).where(F.col("least") < F.col("most")).select("name", "rows"))
    owners = join_one(first.select("name", "context", owner.alias("doc_id")), mixed, ["name"])
    marks = small_side(owners.groupBy("doc_id").agg(F.collect_set("context").alias("marks")), BROADCAST_ROWS)
    windows = stash(_windows(segments.join(marks, "doc_id"), rounds, window))
    least = windows.groupBy("name", "window").agg(F.min(place).alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("rows")).where(F.col("first.doc_id") < F.col("last"))
    met = join_one(windows, stash(least.select("name", "window", "first", "rows")), ["name", "window"])
    single = met.where(F.col("doc_id") > F.col("first.doc_id")).select("doc_id", "hash", "at", F.lit(1).alias("n"), "first")
    return settled.unionByName(single), segments


def _joined(spans: Column, window: int) -> Column:
    """Sorted spans (at, n windows) as stretches (at, n words) of words; those that touch become one."""

    def add(out: Column, x: Column) -> Column:
        stop = x["at"] + x["n"] + F.lit(window - 1)
        last = F.try_element_at(out, F.lit(-1))
        touches = (F.size(out) > 0) & (x["at"] <= last["at"] + last["n"])
        grown = F.struct(last["at"].alias("at"), F.greatest(last["n"], stop - last["at"]).alias("n"))
        return F.when(touches, F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(grown))).otherwise(F.concat(out, F.array(F.struct(x["at"].alias("at"), (stop - x["at"]).alias("n")))))

    return F.aggregate(spans, F.array().cast("array<struct<at: int, n: int>>"), add)


def passages(found: DataFrame, segments: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, hash, at, words: repeated passages, and the words that stand where they are repeated from."""
    ahead = F.col("at") - F.col("first.at")
    key = ["doc_id", "hash", F.col("first.doc_id").alias("of_id"), F.col("first.hash").alias("of_hash"), F.col("first.seg").alias("seg"), ahead.alias("ahead")]
    spans = found.select(*key, F.struct("at", "n").alias("span")).groupBy("doc_id", "hash", "of_id", "of_hash", "seg", "ahead").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    whole = spans.select("doc_id", "hash", "of_id", "of_hash", "seg", "ahead", F.explode(_joined(F.col("spans"), window)).alias("x"))
    whole = stash(whole.select("doc_id", "hash", "of_id", "of_hash", "seg", F.col("x.at").alias("at"), (F.col("x.at") - F.col("ahead")).alias("of_at"), F.col("x.n").alias("n")))
    keys = ["of_id", "of_hash", "seg", "of_at", "n"]
    wanted = whole.groupBy(*keys).agg(F.count("*").alias("rows")).groupBy("of_id", "of_hash", "seg").agg(F.collect_list(F.struct("of_at", "n", "rows")).alias("wanted"))
    texts = segments.select(F.col("doc_id").alias("of_id"), F.col("hash").alias("of_hash"), "seg", "text").join(wanted, ["of_id", "of_hash", "seg"])
    cut = texts.select("of_id", "of_hash", "seg", F.split("text", r"[ \t\n\x0B\f\r]+").alias("w"), F.explode("wanted").alias("x"))
    cut = cut.select("of_id", "of_hash", "seg", F.col("x.of_at").alias("of_at"), F.col("x.n").alias("n"), F.col("x.rows").alias("rows"), F.array_join(F.slice("w", F.col("x.of_at") - F.col("seg") + 1, F.col("x.n")), " ").alias("words"))
    cut = stash(cut.groupBy(*keys).agg(F.max("rows").alias("rows"), F.first("words").alias("words")))  # repeated rows have the same words
    return join_one(whole, cut, keys).select("doc_id", "hash", "at", "words")


def remove(docs: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) for each row of docs.

    A null text has no words. Windows of fewer words than a document's are all there is to find: shorter documents stay
    whole. Windows are judged on the input. A null doc_id is neither smaller nor greater than another, so such rows stay
    whole and nothing is removed because of them. Rows that share a doc_id don't remove each other's words, and each
    loses only words of its own text; doc_id may have any type that can be ordered. Words go only if they equal, word by
    word, those of the other document.
    """
    found, segments = hits(docs, window, rounds)
    repeats = passages(found, segments, window).groupBy("doc_id", "hash").agg(F.collect_set(F.struct("at", "words")).alias("ranges"))
    repeats = stash(repeats.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "ranges"))
    given = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("hash") == F.col("_hash"))
    if repeats.count() <= broadcast_rows:
        keys = small_side(repeats.select("_id", "_hash"), broadcast_rows)
        nothing = F.lit(None).cast(repeats.schema["ranges"].dataType).alias("ranges")
        untouched = given.join(keys, same, "left_anti").select("doc_id", "text", nothing)
        joined = untouched.unionByName(given.join(keys, same, "left_semi").join(repeats, same).select("doc_id", "text", "ranges"))
    else:
        joined = given.join(repeats, same, "left").select("doc_id", "text", "ranges")

    def make() -> Any:
        def work(ids: list, texts: list[str], ranges: list[list[dict] | None]) -> list[list]:
            total, removed, kept = [], [], []
            for text, own in zip(texts, ranges, strict=True):
                words = text.encode().split()
                total.append(len(words))
                if own:
                    stay = np.ones(len(words), bool)
                    for r in own:
                        theirs = r["words"].encode().split()
                        if words[r["at"] : r["at"] + len(theirs)] == theirs:
                            stay[r["at"] : r["at"] + len(theirs)] = False
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            return [ids, total, removed, kept]

        return work

    return map_blocks(joined, make, f"{_kind(docs)}, n_words long, n_removed long, kept string")
