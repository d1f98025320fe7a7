"""Byte-level BPE encoding and decoding by backtracking from longest matches.

The bytes of a piece are read as Latin-1 characters, so that an Aho-Corasick automaton over characters finds every
token in it. Encoding takes the longest token at each place, falls back to its next shorter prefix where it isn't
compatible with the token before it (or leads to a place already known to fail), and steps back where none is left.
Each place fails once at most, so the work is linear in the piece.
"""

from __future__ import annotations

from array import array
from typing import Any

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import map_blocks
from .merges import Merges

#: Pieces remembered by one Python worker, and the length of the longest.
MEMO_PIECES, MEMO_CHARS = 300_000, 64
_built: dict[tuple[int, int, str], Encoder] = {}


class _Pieces(dict):
    """Packed ids of pieces, filled when first asked for."""

    def __init__(self, encode: Any) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece.encode("utf-8")).tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """encode() gives ids as little-endian unsigned 32-bit integers, decode() bytes."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.merges = Merges.from_ranks(rank_file)
        self.find = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for at, token in enumerate(self.merges.tokens):
            self.automaton.add_word(token.decode("latin-1"), at)
        self.automaton.make_automaton()
        self.shorter = [next((self.merges.rank[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.merges.rank), -1) for t in self.merges.tokens]
        self.pieces = _Pieces(self.encode_piece)

    def encode_piece(self, piece: bytes) -> array:
        """A piece that is a token itself is that token, as in the rank file's own library."""
        merges = self.merges
        if (whole := merges.rank.get(piece)) is not None:
            return array("I", [whole])
        if not piece:
            return array("I")
        length, shorter, compatible, end = merges.length, self.shorter, merges.compatible, len(piece)
        longest = [-1] * end
        for last, token in self.automaton.iter(piece.decode("latin-1")):
            longest[last + 1 - length[token]] = token  # ends come in order, so the longest stays
        fails, out, at, token = bytearray(end + 1), [], 0, longest[0]
        while True:
            after = at + length[token]
            if not fails[after] and (not out or compatible(out[-1], token)):
                out.append(token)
                if after == end:
                    return array("I", out)
                at, token = after, longest[after]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                fails[at] = 1
                token = out.pop()
                at -= length[token]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, array("I", ids)))


def encoder(rank_file: bytes, pattern: str) -> Encoder:
    """The encoder of this process."""
    key = (len(rank_file), hash(rank_file), pattern)
    if key not in _built:
        _built.clear()
        _built[key] = Encoder(rank_file, pattern)
    return _built[key]


def encode(df: DataFrame, rank_path: str, pattern: str, columns: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The named columns, ids, decoded for each row: the whole text's ids (packed, four little-endian bytes each) and the bytes they decode to.

    A null text counts as empty and has no ids; repeated rows and nulls in other columns stay; columns that aren't named
    are left out. The driver reads the rank file and sends it along (its size is that of a vocabulary, not of the data).
    """
    with open(rank_path, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    def make() -> Any:
        own = encoder(sent.value, pattern)

        def work(*given: list) -> list[list]:
            ids = [own.encode(t) for t in given[-1]]
            return [*given[:-1], ids, [own.decode(x) for x in ids]]

        return work

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)
    return map_blocks(df.select(*(df[f"`{c}`"] for c in columns), F.col(text).alias("_encoded")), make, f"{fields}ids binary, decoded binary", len(columns))
