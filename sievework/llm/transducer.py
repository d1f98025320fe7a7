"""Token counts by deterministic transducers, without building the tokens.

Two transducers run one after the other.

1. Splitter. A text's characters become class symbols (with one symbol of lookahead); eight states tell where a piece
   starts. The text is cut into chunks; each chunk's map from every entry state to its exit state is computed with all
   chunks in lockstep, the maps are composed by a parallel prefix scan, and a second lockstep pass from the entry
   states now known marks the piece starts.
2. Counter. Over the bytes, a transducer whose transitions carry the change in the number of emitted tokens. A state
   holds, for every place from which a token may still be growing, the token that ends there, how far the growing one
   has come in the trie of tokens, and the count there relative to the present one. States are made when first reached
   and remembered up to a bound. A piece starts in state 0, so the map of a chunk of bytes is constant from its first
   piece start on. All chunks run from there in lockstep; a scan over the maps gives every chunk the state that it is
   entered in, and what lies before its first piece start runs from that, again in lockstep. A chunk without a piece
   start hands its own exit on.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from .blocks import map_blocks
from .merges import Merges

#: Remembered transitions of the counter, and slots of the table in which they are looked up (a power of two).
MEMO_STEPS, SLOTS = 600_000, 1 << 21

# Symbols: one for each way in which the split pattern treats a character.
OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE, ONE, R, E, V, L, BREAK = range(12)
# States of the splitter: before a piece; in letters, numbers, others; after a space that joins what follows; in white
# space; after a quote that starts a piece; before the last letter of a contraction.
FRESH, LETTERS, NUMBERS, OTHERS, JOINED, WHITES, QUOTED, LAST = range(8)
_SYMBOLS, _STATES = 12, 8
_LETTERS = {LETTER, ONE, R, E, V, L}


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """next state and piece-start mark by [symbol * 12 + lookahead, state].

    Pieces: contractions 's 't 're 've 'm 'll 'd; an optional space and letters, numbers or others; white space but for
    the last character before something else; that character alone if it isn't a space.
    """
    step = np.zeros((_SYMBOLS * _SYMBOLS, _STATES), np.uint8)
    mark = np.zeros((_SYMBOLS * _SYMBOLS, _STATES), np.uint8)
    for now in range(_SYMBOLS):
        for ahead in range(_SYMBOLS):
            for state in range(_STATES):
                step[now * _SYMBOLS + ahead, state], mark[now * _SYMBOLS + ahead, state] = _rule(now, ahead, state)
    return step, mark


def _rule(now: int, ahead: int, state: int) -> tuple[int, int]:
    white = (SPACE, WHITE)
    if now == BREAK:
        return FRESH, 0
    if now in white:
        run_goes_on = ahead in white or ahead == BREAK
        if state == WHITES and run_goes_on:
            return WHITES, 0
        return (WHITES if run_goes_on else JOINED if now == SPACE else FRESH), 1
    run = LETTERS if now in _LETTERS else NUMBERS if now == NUMBER else OTHERS
    if state == JOINED:
        return run, 0
    if state == LAST:
        return FRESH, 0
    if state == QUOTED:
        if now == ONE:
            return FRESH, 0
        if (now, ahead) in ((R, E), (V, E), (L, L)):
            return LAST, 0
        state = OTHERS
    if state == run:
        return run, 0
    return (QUOTED if now == QUOTE else run), 1


class Symbols:
    """A symbol for each code point, asked of the library's own splitter when a code point is first met.

    Libraries follow different versions of Unicode, so no table of ours would agree with it everywhere.
    """

    def __init__(self) -> None:
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.table = np.full(0x110000, OTHER, np.uint8)
        self.known = np.zeros(0x110000, bool)
        for chars, symbol in ((" ", SPACE), ("'", QUOTE), ("stmd", ONE), ("r", R), ("e", E), ("v", V), ("l", L)):
            at = [ord(c) for c in chars]
            self.table[at], self.known[at] = symbol, True

    def of(self, points: np.ndarray) -> np.ndarray:
        if not self.known[points].all():
            for point in np.unique(points[~self.known[points]]).tolist():
                joins = [len(self.split(first + chr(point))) == 1 for first in "a1!"]
                self.table[point] = LETTER if joins[0] else NUMBER if joins[1] else OTHER if joins[2] else WHITE
                self.known[point] = True
        return self.table[points]


def piece_starts(symbols: np.ndarray, step: np.ndarray, mark: np.ndarray, chunk: int = 1024) -> np.ndarray:
    """Positions at which pieces start; the last symbol must be BREAK."""
    n = len(symbols)
    pairs = symbols.astype(np.int32) * _SYMBOLS
    pairs[:-1] += symbols[1:]
    pairs[-1] += BREAK
    chunk = max(1, min(chunk, int(n**0.5) + 1))
    many = -(-n // chunk)
    padded = np.full(many * chunk, BREAK * _SYMBOLS + BREAK, np.int32)
    padded[:n] = pairs
    lanes = np.ascontiguousarray(padded.reshape(many, chunk).T)  # [place in chunk, chunk]
    flat_step, flat_mark = step.ravel(), mark.ravel()
    maps = np.tile(np.arange(_STATES, dtype=np.uint8), (many, 1))
    for row in lanes:
        maps = flat_step[(row * _STATES)[:, None] + maps]
    reach = 1
    while reach < many:  # prefix scan: after it, maps[i] takes the state before chunk 0 to that after chunk i
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].copy(), axis=1)
        reach *= 2
    state = np.full(many, FRESH, np.int32)
    state[1:] = maps[:-1, FRESH]
    marks = np.zeros((chunk, many), np.uint8)
    for at, row in enumerate(lanes):
        where = row * _STATES + state
        marks[at] = flat_mark[where]
        state = flat_step[where].astype(np.int32)
    return np.flatnonzero(marks.T.ravel()[:n])


class Counter:
    """Token counts as the library gives them for a byte-level BPE tokenizer file without a normaliser."""

    def __init__(self, tokenizer_file: str) -> None:
        spec = json.loads(tokenizer_file)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only byte-level BPE with the plain split pattern is compiled")
        byte_of = {c: b for b, c in _byte_letters().items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        names = sorted(byte_of, key=byte_of.__getitem__) + [a + b for a, b in pairs]
        self.merges = Merges([bytes(map(byte_of.__getitem__, x)) for x in names])
        number = {x: i for i, x in enumerate(names)}
        for a, b in pairs:
            self.merges.add(number[a], number[b], number[a + b])
        self.special = [x["content"] for x in spec.get("added_tokens") or [] if x["content"]]
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec.get("added_tokens") or []):
            raise ValueError("added tokens that strip or match words only aren't compiled")
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.symbols, (self.step, self.mark) = Symbols(), splitter()
        self.child: dict[int, int] = {}
        self.ends = [-1]
        for at, token in enumerate(self.merges.tokens):
            node = 0
            for b in token:
                node = self.child.setdefault(node << 8 | b, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = at
        self._forget()

    def _forget(self) -> None:
        self.state_of: dict[tuple, int] = {((0, -1, 0),): 0}
        self.content: list[tuple] = [((0, -1, 0),)]
        self.steps: dict[int, tuple[int, int]] = {}
        self.keys = np.full(SLOTS, -1, np.int64)
        self.after, self.change = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int16)

    def _make(self, state: int, byte: int) -> tuple[int, int]:
        """The state after one more byte, and the change in tokens."""
        grown, last, count = [], -1, 0
        for node, before, emitted in self.content[state]:
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            grown.append((to, before, emitted))
            token = self.ends[to]
            if token >= 0 and last < 0 and (before < 0 or self.merges.compatible(before, token)):
                last, count = token, emitted + 1
        after = (*((node, before, emitted - count) for node, before, emitted in grown), (0, last, 0))
        number = self.state_of.get(after)
        if number is None:
            number = self.state_of[after] = len(self.content)
            self.content.append(after)
        self.steps[state << 8 | byte] = found = (number, count)
        return found

    def _step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and changes for many states and bytes. A transition has two slots; what isn't in either is made or remembered."""
        key = state.astype(np.int64) << 8 | byte
        slot = (key * 0x9E3779B1 >> 7) & (SLOTS - 1)
        bad = np.flatnonzero(self.keys[slot] != key)
        if len(bad):
            slot[bad] = (key[bad] * 0x85EBCA77 >> 9) & (SLOTS - 1)
            bad = bad[self.keys[slot[bad]] != key[bad]]
        out, change = self.after[slot], self.change[slot]
        for at in bad.tolist():
            k = int(key[at])
            out[at], change[at] = found = self.steps.get(k) or self._make(k >> 8, k & 255)
            first, second = (k * 0x9E3779B1 >> 7) & (SLOTS - 1), (k * 0x85EBCA77 >> 9) & (SLOTS - 1)
            free = first if self.keys[first] < 0 else second
            self.keys[free], self.after[free], self.change[free] = k, *found
        return out, change

    def changes(self, data: np.ndarray, starts: np.ndarray, skip: np.ndarray, chunk: int = 1024) -> np.ndarray:
        """The change in tokens at each byte. starts: does a piece start there? skip: is it outside of pieces?"""
        n = len(data)
        chunk = min(chunk, 1 << (n.bit_length() + 1 >> 1))
        many = -(-n // chunk)

        def lanes(x: np.ndarray, fill: int) -> np.ndarray:
            padded = np.full(many * chunk, fill, x.dtype)
            padded[:n] = x
            return np.ascontiguousarray(padded.reshape(many, chunk).T)  # [place in chunk, chunk]

        bytes_, begins, used = lanes(data, 0), lanes(starts, 0), lanes(~skip, 0)
        out = np.zeros((chunk, many), np.int16)
        has = begins.any(axis=0)
        head = np.where(has, begins.argmax(axis=0), chunk)
        state = np.zeros(many, np.int32)

        def run(chosen: np.ndarray, first: np.ndarray, stop: np.ndarray) -> None:
            """Run the chosen chunks from their first to their stop places; state is where each begins and then where it ends."""
            for at in range(int(first.min(initial=chunk)), int(stop.max(initial=0))):
                live = chosen[(first <= at) & (at < stop)]
                live = live[used[at, live]]
                fresh = live[begins[at, live]]
                state[fresh] = 0
                state[live], out[at, live] = self._step(state[live], bytes_[at, live])

        every = np.arange(many)
        run(every[has], head[has], np.full(int(has.sum()), chunk))
        enter = np.zeros(many, np.int32)  # the state before each chunk
        enter[1:][has[:-1]] = state[:-1][has[:-1]]
        whole = every[~has]
        if len(whole):
            ends = np.full(len(whole), chunk)

            def through(chosen: np.ndarray, entries: np.ndarray) -> np.ndarray:
                """Exit states of whole chunks from these entry states."""
                state[whole[chosen]] = entries
                run(whole[chosen], np.zeros(len(chosen), np.int64), ends[chosen])
                return state[whole[chosen]].copy()

            first = (whole == 0) | has[whole - 1]
            enter[whole] = _entries(first, np.where(first, enter[whole], 0), through)
            after = whole[whole + 1 < many]
            enter[after + 1] = state[after]
        rest = every[has & (head > 0)]
        state[rest] = enter[rest]
        run(rest, np.zeros(len(rest), np.int64), head[rest])
        return out.T.ravel()[:n]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if len(self.steps) > MEMO_STEPS:
            self._forget()
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        symbols = self.symbols.of(points)
        symbols[ends - 1] = BREAK
        total = np.zeros(len(texts), np.int64)
        if self.cut is not None:
            for m in self.cut.finditer(joined):
                symbols[m.start() : m.end()] = BREAK
                total[np.searchsorted(ends, m.start(), "right")] += 1
        sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        stops = np.cumsum(sizes)
        data = np.frombuffer(joined.encode(), np.uint8)
        starts = np.zeros(len(data), bool)
        at = piece_starts(symbols, self.step, self.mark)
        starts[stops[at] - sizes[at]] = True
        sums = np.cumsum(self.changes(data, starts, np.repeat(symbols == BREAK, sizes)), dtype=np.int64)
        return total + np.diff(sums[stops[ends - 1] - 1], prepend=0)


def _entries(first: np.ndarray, given: np.ndarray, through: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Entry states of a row of chunks, each of which is left through a map of states that is dear to ask for.

    Chunks marked first are entered in the given states, the others in what the one before them leaves. Each chunk's map
    is kept for the states asked so far; any other state is taken to leave the chunk as the last one asked did. These
    maps are composed by a prefix scan, and the entries that come out are asked where they aren't known, all chunks
    together, until every one is known: then they are right, chunk after chunk. Counts forget where they began after a
    token or two, so two or three rounds are the rule; a text of one repeated token needs at most as many as the token
    has places. The last run of each chunk is the one from its entry.
    """
    many = len(first)
    number: dict[int, int] = {}
    states: list[int] = []

    def numbers(of: np.ndarray) -> np.ndarray:
        for x in np.unique(of).tolist():
            if x not in number:
                number[x] = len(states)
                states.append(x)
        return np.fromiter((number[x] for x in of.tolist()), np.int32, len(of))

    asked: dict[tuple[int, int], int] = {}
    entry, latest, ran = numbers(given), np.zeros(many, np.int32), np.full(many, -1, np.int32)
    again = np.arange(many)
    while True:
        latest[again] = numbers(through(again, np.asarray(states, np.int32)[entry[again]]))
        ran[again] = entry[again]
        asked.update(zip(zip(again.tolist(), entry[again].tolist()), latest[again].tolist()))
        maps = np.repeat(latest[:, None], len(states), axis=1)
        if len(asked) > many:
            where = np.array(list(asked), np.int64)
            maps[where[:, 0], where[:, 1]] = list(asked.values())
        maps[first] = latest[first, None]
        reach = 1
        while reach < many:  # after it, maps[i] takes the state before chunk 0 to that after chunk i
            maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].copy(), axis=1)
            reach *= 2
        entry[1:] = np.where(first[1:], entry[1:], maps[:-1, 0])
        unknown = [i for i, e in enumerate(entry.tolist()) if (i, e) not in asked]
        if not unknown:
            break
        again = np.asarray(unknown)
    again = np.flatnonzero(ran != entry)
    if len(again):
        through(again, np.asarray(states, np.int32)[entry[again]])
    return np.asarray(states, np.int32)[entry]


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write printable bytes as themselves and the others as the characters from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_built: dict[int, Counter] = {}


def count_tokens(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows key, n_bytes, n_tokens for each whole text.

    A null text counts as empty: no bytes, no tokens. Repeated rows stay, the key may be null, other columns are left
    out. The driver reads the tokenizer file and sends it along; its size is that of a vocabulary.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    def make() -> Any:
        spec = sent.value
        own = _built.get(hash(spec))
        if own is None:
            _built.clear()
            own = _built[hash(spec)] = Counter(spec)

        def work(keys: list, texts: list[str], sizes: list[int]) -> list:
            return [keys, sizes, own.count(texts)]

        return work

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return map_blocks(rows, make, f"key {kind}, n_bytes long, n_tokens long").withColumnRenamed("key", key)
