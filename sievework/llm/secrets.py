"""Secret scans over an inverted index of trigrams.

Each block of texts gets postings (trigram -> texts) of the trigrams that the rules mention; a rule's Boolean query
is answered by intersecting and uniting postings, and only the texts left are searched with the rule itself. A rule
without a mandatory trigram scans all texts. Blocks are independent, so nothing is shuffled and no posting list
outgrows a block.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import map_blocks
from .trigrams import Query, mentioned, query


@dataclass(frozen=True)
class Rule:
    """Matches of pattern whose group has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base rules.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Public key formats. Each may start only where a run of its characters does, or has a bounded length, so that
# searching takes time in proportion to the text.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9._~+/-]{20,}=*)"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,31}://[^\s:/@]{1,64}:([^\s:/@]{3,64})@"),
)
RULES = BASE_RULES + MORE_RULES
MARK = "[SECRET]"


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.search = [re.compile(r.pattern, re.ASCII) for r in rules]
        self.queries: list[Query] = [query(r.pattern, re.ASCII) for r in rules]
        self.trigrams = sorted(set().union(*map(mentioned, self.queries)))
        self.number = {t: i for i, t in enumerate(self.trigrams)}
        self.table = np.full(1 << 24, -1, np.int16)
        for i, t in enumerate(self.trigrams):
            self.table[t[0] << 16 | t[1] << 8 | t[2]] = i

    def postings(self, texts: list[str]) -> np.ndarray:
        """[trigram, text]: does the text, lower-cased, have it? Byte 255 is in no text and keeps neighbours apart."""
        coded = [t.encode().lower() for t in texts]
        data = np.frombuffer(b"\xff".join(coded) + b"\xff\xff", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)
        code = data[:-2].astype(np.uint32)
        for k in (1, 2):
            code <<= 8
            code |= data[k : len(data) - 2 + k]
        found = self.table[code]
        at = np.flatnonzero(found >= 0)
        out = np.zeros((len(self.trigrams), len(texts)), bool)
        out[found[at], np.searchsorted(ends, at, "right")] = True
        return out

    def candidates(self, q: Query, postings: np.ndarray) -> np.ndarray:
        if q is True:
            return np.ones(postings.shape[1], bool)
        if isinstance(q, bytes):
            return postings[self.number[q]]
        return (np.logical_and if q[0] == "and" else np.logical_or).reduce([self.candidates(x, postings) for x in q[1]])

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of each text by start, then by the order of the rules; offsets in code points."""
        postings = self.postings(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for order, (rule, search, q) in enumerate(zip(self.rules, self.search, self.queries, strict=True)):
            for i in np.flatnonzero(self.candidates(q, postings)).tolist():
                found[i] += [(m.start(), order, m.end()) for m in search.finditer(texts[i]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return [[(self.rules[order].kind, a, b) for a, order, b in sorted(x)] for x in found]


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], MARK]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows key, findings (array of kind, start, end), redacted: one for each row, whole texts.

    A null text counts as empty and has no findings; repeated rows stay; the key may be null; other columns are left out.
    """

    def make() -> Any:
        scanner = Scanner(rules)

        def work(keys: list, texts: list[str]) -> list[list]:
            found = scanner.scan(texts)
            return [keys, [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in found], [redacted(t, x) for t, x in zip(texts, found, strict=True)]]

        return work

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_blocks(rows, make, f"key {kind}, findings array<struct<kind: string, start: long, end: long>>, redacted string").withColumnRenamed("key", key)


def redact(df: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows and columns, with secrets in the text masked and the length column, if there is one, set anew where they were.

    A null text stays null, an empty one empty; repeated rows and rows without a key stay; an empty table gives no rows.
    """
    names = df.columns
    at = names.index(text)

    def make() -> Any:
        scanner = Scanner()

        def work(*columns: list) -> list[list]:
            texts, out = columns[-1], list(columns[:-1])
            found = scanner.scan(texts)
            out[at] = [old and redacted(t, x) for old, t, x in zip(out[at], texts, found, strict=True)]
            if length in names:
                where = names.index(length)
                out[where] = [len(t) if x else n for n, t, x in zip(out[where], out[at], found, strict=True)]
            return out

        return work

    return map_blocks(df.select(*(df[f"`{c}`"] for c in names), F.col(f"`{text}`").alias("_scanned")), make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), len(names))
