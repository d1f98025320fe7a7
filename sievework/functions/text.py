"""Scalar text functions as column expressions; Python runs only where built-in functions can't say it."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def vectorized(kind: str) -> Callable[[Callable], Callable[..., Column]]:
    """A pandas UDF that is made when it is first used, as there may be no session before."""

    def wrap(f: Callable) -> Callable[..., Column]:
        f.__annotations__ = {k: {"pd.Series": pd.Series, "pd.DataFrame": pd.DataFrame}.get(v, v) for k, v in f.__annotations__.items()}
        return lambda *columns: F.pandas_udf(f, kind)(*columns)

    return wrap


# The entities that are decoded without Python.
NAMED_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#34;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "©", "&reg;": "®", "&middot;": "·", "&mdash;": "—", "&ndash;": "–", "&hellip;": "…", "&amp;": "&"}
SENTENCE_BREAK = r"(?<=[.;])\s+(?=[A-Z0-9(])"
LOOSE_BREAK = r"(?<=[.;])\s+"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- normalising -------------------------------------------------------------------------------------------------


def collapse(x: Column | str) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(col(x), r"(?U)\s+", " "))


def decode_entities(x: Column | str) -> Column:
    """The entities of NAMED_ENTITIES, the ampersand last, so that nothing is decoded twice."""
    out = col(x)
    for name, char in NAMED_ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


@vectorized("string")
def decode_all_entities(x: pd.Series) -> pd.Series:
    """Every HTML entity, named and numeric."""
    return x.map(html.unescape, na_action="ignore")


@vectorized("string")
def nfc(x: pd.Series) -> pd.Series:
    """Unicode's composed normal form."""
    return x.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def norm_text(x: Column | str, decode: object = decode_entities) -> Column:
    """Entities are decoded first, as one may stand for white space; then white space is collapsed."""
    return collapse(decode(col(x)))


def name_key(x: Column | str) -> Column:
    return F.lower(collapse(x))


def clean_field(x: Column | str) -> Column:
    """Fit for a field of a tab-separated file; null becomes empty."""
    return F.coalesce(collapse(col(x).cast("string")), F.lit(""))


def has_entity(x: Column | str) -> Column:
    return F.rlike(col(x), F.lit(r"&(#\d+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"))


def has_inner_entity(x: Column | str) -> Column:
    """An entity between two letters: likely a misread character."""
    return F.rlike(col(x), F.lit(r"[A-Za-z]&(#\d+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);[A-Za-z]"))


def html_to_text(markup: Column | str, blocks_to_lines: bool = False) -> Column:
    """Text of a page: scripts, styles and preformatted parts go, tags become spaces (block ends, if asked, line ends)."""
    out = F.regexp_replace(col(markup), r"(?is)<(script|style|pre)\b[^>]*>.*?</\1>", " ")
    if blocks_to_lines:
        out = F.regexp_replace(out, r"(?i)</?(p|div|br|li|ul|ol|tr|td|h[1-6]|section|article)\b[^>]*>", "\n")
    out = decode_entities(F.regexp_replace(out, r"<[^>]+>", " "))
    lines = F.regexp_replace(F.regexp_replace(out, r"[ \t\r\f]+", " "), r" ?\n[\n ]*", "\n")
    return F.regexp_replace(lines, r"^\s+|\s+$", "") if blocks_to_lines else collapse(out)


# ---- splitting ---------------------------------------------------------------------------------------------------


def sentences(x: Column | str) -> Column:
    """Pieces that end in a period or semicolon before a capital, digit or bracket; the mark stays on the left."""
    return F.split(col(x), SENTENCE_BREAK)


def loose_sentences(x: Column | str) -> Column:
    return F.split(col(x), LOOSE_BREAK)


def line_sentences(x: Column | str) -> Column:
    """Lines, then pieces after a period, exclamation or question mark; blank pieces are left out."""
    pieces = F.flatten(F.transform(F.split(col(x), "\n"), lambda s: F.split(s, r"(?<=[.!?])\s+")))
    return F.filter(F.transform(pieces, lambda s: F.trim(s)), lambda s: s != "")


def clauses(x: Column | str) -> Column:
    return F.split(col(x), r"(?i)[,;:]\s+|\s+(?:and|but|with|while|which)\s+")


def sentence_at(text: Column | str, at: Column, most: int = 400) -> Column:
    """The sentence around a position (from 1): from after the last ". " before it to the next one, lower, cut to `most`."""
    before = F.substring(col(text), F.lit(1), at - 1)
    start = F.length(before) - F.locate(" .", F.reverse(before)) + 1
    start = F.when(F.locate(" .", F.reverse(before)) == 0, F.lit(0)).otherwise(start)
    stop = F.locate(". ", F.substring(col(text), at, F.lit(most)))
    stop = F.when(stop == 0, at + most - 1).otherwise(at + stop - 2)
    return F.substring(F.lower(collapse(F.substring(col(text), start + 1, stop - start))), 1, most)


def context(text: Column | str, at: Column, length: Column, width: int = 55) -> Column:
    """`width` characters to both sides of a match (from 1), collapsed, lower."""
    start = F.greatest(F.lit(1), at - width)
    return F.lower(collapse(F.substring(col(text), start, at + length + width - start)))


# What a full stop after doesn't end a sentence; so does a single capital letter.
ABBREVIATIONS = (
    "e.g", "i.e", "No", "Nos", "Pat", "U.S", "al", "ca", "approx", "Fig", "Figs", "cf", "vol", "Vol", "p", "pp",
    "Ex", "Ed", "Co", "Inc", "Ltd", "Corp", "Dr", "Mr", "St", "resp", "wt", "min", "hr", "mm", "ml", "g", "b.p", "m.p",
    "vs", "J", "Chem", "Soc", "Am", "Acad", "Sci", "Org", "Agric", "Food", "Od",
)
_SHORT = "|".join(re.escape(a) for a in ABBREVIATIONS)
#: A full stop and white space before more text, but for those after abbreviations and those between digits.
SEGMENT_END = rf"(?<!\b(?:{_SHORT}|[A-Z]))(?:(?<!\d)\.\s+(?=\S)|(?<=\d)\.\s+(?=[^\s\d]))"


def segments(x: Column | str) -> Column:
    """Offsets a, b (code points from 0) of the parts of a sentence between full stops inside it; together they are the whole."""
    ends = F.transform(pattern_spans(x, SEGMENT_END), lambda m: m["stop"])
    cuts = F.concat(F.array(F.lit(0)), ends, F.array(F.length(col(x))))
    return F.transform(F.slice(cuts, 1, F.size(cuts) - 1), lambda a, i: F.struct(a.alias("a"), F.get(cuts, i + 1).alias("b")))


# ---- finding -----------------------------------------------------------------------------------------------------


def offset(text: Column | str, span: Column | str) -> Column:
    """First place of a span in code points from 0; null if it isn't there."""
    at = F.position(col(span), col(text))
    return F.when(at > 0, at - 1)


def verbatim(text: Column | str, span: Column | str) -> Column:
    return F.contains(col(text), col(span))


def pattern_spans(x: Column | str, pattern: Column | str) -> Column:
    """start and stop (code points from 0) of all matches of a pattern, in the text as it is."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    lengths = lambda xs: F.transform(xs, lambda y: F.length(y))
    # Gaps and matches go into the aggregation as its rows: what a function of it names outside of them is made anew for each.
    read = F.arrays_zip(lengths(F.split(col(x), p)).alias("gap"), lengths(F.regexp_extract_all(col(x), p, 0)).alias("match"))

    def add(out: Column, m: Column) -> Column:
        start = F.coalesce(F.try_element_at(out, F.lit(-1))["stop"], F.lit(0)) + m["gap"]
        return F.concat(out, F.array(F.struct(start.alias("start"), (start + m["match"]).alias("stop"))))

    nothing = F.array().cast("array<struct<start: int, stop: int>>")
    return F.coalesce(F.aggregate(F.filter(read, lambda m: m["match"].isNotNull()), nothing, add), nothing)


def _quoted(x: Column) -> Column:
    """A text as a pattern that matches it alone."""
    return F.concat(F.lit("\\Q"), F.replace(x, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def spans_of(needle: Column | str, hay: Column | str) -> Column:
    """start and stop of all occurrences, case ignored, that don't overlap; an empty needle has none."""
    found = pattern_spans(hay, F.concat(F.lit("(?iu)"), _quoted(col(needle))))
    return F.when(F.length(col(needle)) > 0, found).otherwise(F.array().cast("array<struct<start: int, stop: int>>"))


def find_all(needle: Column | str, hay: Column | str) -> Column:
    """Offsets (from 0) of all occurrences, case ignored, that don't overlap."""
    return F.transform(spans_of(needle, hay), lambda m: m["start"])


def stem_spans(word: Column | str, hay: Column | str, stem: int = 5) -> Column:
    """Spans of the word, or, if there are none, of the words that begin with its first letters."""
    exact = spans_of(word, hay)
    starts = pattern_spans(hay, F.concat(F.lit("(?iuU)\\b"), _quoted(F.substring(col(word), 1, stem)), F.lit("\\w*")))
    return F.when(F.size(exact) > 0, exact).otherwise(starts)


def stem_hits(word: Column | str, hay: Column | str, stem: int = 5) -> Column:
    """How often the word occurs, or, if it doesn't, how many words begin with its first letters."""
    return F.size(stem_spans(word, hay, stem))


def vocabulary_pattern(terms: Iterable[str], loose: bool = False) -> str:
    """One alternation, longest term first. loose: only letters and digits count as parts of a word, for names with brackets."""
    body = "|".join(re.escape(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))
    return rf"(?iu)(?<![A-Za-z0-9])({body})(?![A-Za-z0-9])" if loose else rf"(?iU)\b({body})\b"


def mentions(x: Column | str, pattern: str) -> Column:
    """All matches of a vocabulary pattern, lower."""
    return F.transform(F.regexp_extract_all(col(x), F.lit(pattern), 1), lambda w: F.lower(w))


def words(x: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(x)), F.lit(r"(\p{L}+)"), 1)


def content_words(x: Column | str, stop: Iterable[str]) -> Column:
    """Words of more than two characters that are neither stopped nor digits; hyphens at the ends go."""
    stopped = F.array(*(F.lit(s) for s in sorted(set(stop)))) if stop else F.array().cast("array<string>")
    pieces = F.transform(F.split(F.lower(col(x)), r"[^\p{L}\p{N}-]+"), lambda w: F.regexp_replace(w, "^-+|-+$", ""))
    return F.filter(pieces, lambda w: (F.length(w) > 2) & ~F.array_contains(stopped, w) & ~F.rlike(w, F.lit(r"^\d+$")))


def before_head(x: Column | str, heads: Iterable[str]) -> Column:
    """Up to four words before a head noun."""
    return F.regexp_extract_all(F.lower(col(x)), F.lit(rf"\b((?:[a-z][a-z-]{{2,}}[,\s]+){{1,4}})(?:{'|'.join(heads)})\b"), 1)


def after_head(x: Column | str, heads: Iterable[str]) -> Column:
    """What follows a head noun and of, like, reminiscent of or recalling."""
    return F.regexp_extract_all(F.lower(col(x)), F.lit(rf"\b(?:{'|'.join(heads)})\s+(?:of|like|reminiscent of|recalling)\s+\b([a-z][a-z,\s-]{{3,60}})"), 1)


def distinct_words(xs: Column, exclude: Column) -> Column:
    """Lower, in order, each once, without the excluded."""
    return F.array_except(F.array_distinct(F.transform(xs, lambda w: F.lower(w))), exclude)


def suppressed(x: Column | str, pattern: str, not_before: Iterable[str]) -> Column:
    """Matches that aren't followed by one of these words."""
    return F.transform(F.regexp_extract_all(col(x), F.lit(rf"{pattern}(?!\s+(?:{'|'.join(not_before)})\b)"), 1), lambda w: F.lower(w))


def contains_all(hay: Column | str, query: Column | str) -> Column:
    """Every token of the query is somewhere in the text; an empty query matches."""
    tokens = F.filter(F.split(F.lower(F.trim(col(query))), r"\s+"), lambda w: w != "")
    return F.forall(tokens, lambda w: F.contains(F.lower(col(hay)), w))


def in_json(raw_json: Column | str, value: Column | str) -> Column:
    """Whether a value occurs in JSON text, written plainly or with escapes."""
    plain = F.to_json(F.struct(col(value).alias("v")))
    inner = F.substring(plain, F.lit(7), F.length(plain) - 8)
    return F.contains(col(raw_json), inner)


# ---- names -------------------------------------------------------------------------------------------------------

# Greek letters and their names.
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "ω": "omega"}
# Words at the end of a product name that don't belong to it.
QUALIFIERS = ("delta", "coeur", "hc", "total", "supra", "core", "kao", "extra", "pure", "velvet", "ifra", "crystals", "nat", "natural", "liquid", "95")


def squash(x: Column | str) -> Column:
    """A key for misread spellings: letters and digits only, l and i as 1, o as 0."""
    return F.translate(F.regexp_replace(F.lower(col(x)), r"[^a-z0-9]", ""), "loi", "101")


def loose_key(x: Column | str) -> Column:
    """Greek letters spelled out, then letters and digits only."""
    out = F.lower(col(x))
    for letter, name in GREEK.items():
        out = F.replace(out, F.lit(letter), F.lit(name))
    return F.regexp_replace(out, r"[^\p{L}\p{N}]", "")


def product_variants(name: Column | str) -> Column:
    """Forms of a product name: without dilution; parts at aka, slash, dash or semicolon; inside and outside of brackets; without trailing qualifiers."""
    plain = F.regexp_replace(col(name), r"(?i)\b\d+(?:[.,]\d+)?\s*%\s*(?:in\s+)?(?:DPG|TEC|IPM|ethanol|alcohol)?\b\.?", " ")
    pieces = F.split(plain, r"\s+(?:aka|/|–|-)\s+|\s*;\s*")
    inner = lambda p: F.regexp_extract_all(p, F.lit(r"\(([^)]*)\)"), 1)
    forms = F.flatten(F.transform(pieces, lambda p: F.concat(F.array(F.regexp_replace(p, r"\([^)]*\)", " ")), inner(p))))
    forms = F.filter(F.transform(forms, lambda v: collapse(v)), lambda v: v != "")
    tail = rf"(?i)(\s+(?:{'|'.join(QUALIFIERS)}))$"

    def peeled(v: Column) -> Column:
        once = F.regexp_replace(v, tail, "")
        return F.array(v, once, F.regexp_replace(once, tail, ""))

    return F.array_distinct(F.flatten(F.transform(forms, peeled)))


def name_variants(name: Column | str) -> Column:
    """X (Y) stands for itself, X and Y; trade marks go."""
    plain = F.trim(F.regexp_replace(col(name), "[®™]", ""))
    both = F.array(plain, F.trim(F.regexp_extract(plain, r"^(.+?) \((.*)\)$", 1)), F.trim(F.regexp_extract(plain, r"^(.+?) \((.*)\)$", 2)))
    return F.array_distinct(F.filter(both, lambda v: v != ""))


def searchable(names: Column, generic: Iterable[str] = ()) -> Column:
    """Names of six letters or more that are neither generic nor database ids, each once whatever its case."""
    banned = F.array(*(F.lit(g) for g in sorted(generic))) if generic else F.array().cast("array<string>")
    fit = F.filter(names, lambda n: (F.regexp_count(n, F.lit("[A-Za-z]")) >= 6) & ~F.array_contains(banned, F.lower(n)) & ~F.rlike(n, F.lit(r"^(?i:CHEMBL|SCHEMBL|DTXSID|UNII|CAS)[-: ]?\w*\d")))
    return F.filter(fit, lambda n, i: ~F.exists(F.slice(fit, 1, i), lambda m: F.lower(m) == F.lower(n)))


# Repairs in the order in which they apply: id, pattern, replacement.
REPAIRS = (
    ("U1", r"[‐-―−]", "-"),
    ("U1", r"[′’ʹ]", "'"),
    ("W1", r"(?<=[-,(\[])\s+|\s+(?=[-,)\]'])", ""),
    ("W2", r"(\d[a-z]?) (?=[a-z]{3,})", "$1-"),
    ("L1", r"(?<![A-Za-z0-9])(?!^[lI]-[A-Za-z])(?<!\((?=[lI]\)))[lI](?![A-Za-z0-9])", "1"),
    ("L3", r"(?<![A-Za-z])l(?=\d)|(?<=\d)l(?![A-Za-z])", "1"),
    ("L4", r"(?<=[a-z])1(?=[a-z])", "l"),
    ("R1", r"rn(?=ethyl|ethoxy|ethylen)", "m"),
    ("H1", r"\(\s*[1lI]\s*[Hh]\s*\)", "(1H)"),
)
FORMATTING = ("U1", "W1", "W2")


def repaired(x: Column | str, rules: Iterable[str]) -> tuple[Column, Column]:
    """The text after the named repairs, and the ids of those that changed it."""
    now, used = col(x), []
    for rule in dict.fromkeys(r for r, *_ in REPAIRS if r in set(rules)):
        after = now
        for _, pattern, new in (r for r in REPAIRS if r[0] == rule):
            after = F.regexp_replace(after, pattern, new)
        used.append(F.when(after != now, F.lit(rule)))
        now = after
    return now, F.array_compact(F.array(*used)) if used else F.array().cast("array<string>")


@vectorized("string")
def ring_brackets(x: pd.Series) -> pd.Series:
    """l and I as 1, O as 0, but only between the brackets after cyclo or spiro, if a digit is there."""

    def fix(m: re.Match) -> str:
        return m[1] + m[2] + m[3].translate(str.maketrans("lIO", "110")) + m[4] if re.search(r"\d", m[3]) else m[0]

    pattern = re.compile(r"((?:cyclo|spiro)\s*)([\[(])([0-9lIO.,\s]+)([\])])")
    return x.map(lambda s: pattern.sub(fix, s), na_action="ignore")


def orphans(s: str) -> list[int]:
    """Places of brackets without a partner."""
    waiting, out = [], []
    for i, c in enumerate(s):
        if c in "([{":
            waiting.append(i)
        elif c in ")]}":
            if waiting and "([{".index(s[waiting[-1]]) == ")]}".index(c):
                waiting.pop()
            else:
                out.append(i)
    return sorted(out + waiting)


def repair_span(span: str, sentence: str) -> tuple[str | None, str]:
    """A span without a leading label; with a bracket that was clipped off put back; without an orphan at its ends; else none, with the reason."""
    out = re.sub(r"^\s*(?:Example|Compound|Formula)\s+\d+[:.]?\s+", "", span)
    if not orphans(out):
        return (out, "unchanged" if out == span else "label") if out in sentence else (None, "not verbatim")
    at = sentence.find(out)
    if at >= 0:
        for a, b in ((at - 1, at + len(out)), (at, at + len(out) + 1), (at - 1, at + len(out) + 1)):
            if a >= 0 and b <= len(sentence) and not orphans(sentence[a:b]):
                return sentence[a:b], "bracket restored"
    for cut in (out[1:], out[:-1]):
        if cut and not orphans(cut) and cut in sentence:
            return cut.strip(), "orphan trimmed"
    return None, "unbalanced"


@vectorized("struct<span: string, how: string>")
def repaired_span(span: pd.Series, sentence: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([repair_span(a or "", b or "") for a, b in zip(span, sentence, strict=True)], columns=["span", "how"])


def balanced(x: Column | str) -> Column:
    return (F.regexp_count(col(x), F.lit(r"\(")) == F.regexp_count(col(x), F.lit(r"\)"))) & (F.regexp_count(col(x), F.lit(r"\[")) == F.regexp_count(col(x), F.lit(r"\]")))


def clean_name(x: Column | str) -> Column:
    """Without a leading label; a generic formula gives nothing; of "name, i.e. other" and "name (other)" the first stays unless the bracket is stereo."""
    plain = F.regexp_replace(col(x), r"^(?:Example|Compound)\s+\d+[:.]?\s+", "")
    lead = F.trim(F.regexp_extract(plain, r"^(.+?)(?:,? i\.e\..*| \((?![EZRS][,)]).*\))?$", 1))
    return F.when(F.rlike(plain, F.lit(r"(?i)\bformula\s*\(?[IVX]+\)?")), F.lit(None)).otherwise(lead)


def plausible(x: Column | str) -> Column:
    return F.regexp_count(col(x), F.lit("[A-Za-z]")) >= 4


def slug(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(col(x)), "[^a-z0-9]+", "-"), "^-|-$", "")


def ellipsis(x: Column | str, most: int) -> Column:
    return F.when(F.length(col(x)) > most, F.concat(F.substring(col(x), 1, most - 1), F.lit("…"))).otherwise(col(x))


def letter_key(x: Column | str) -> Column:
    """From the first run of three letters on, for sorting labels."""
    found = F.regexp_extract(F.lower(col(x)), r"([a-z]{3}.*)$", 1)
    return F.when(found == "", F.lower(col(x))).otherwise(found)


@vectorized("double")
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching blocks."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in zip(a, b, strict=True)])


def highlight(intervals: Column) -> Column:
    """Of intervals (start, stop), those that don't overlap one chosen before: by start, the longest first at equal starts."""
    ordered = F.array_sort(intervals, lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(y["stop"] - x["stop"]).cast("int"))
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<start: int, stop: int>>").alias("chosen"))

    def step(acc: Column, x: Column) -> Column:
        fits = x["start"] >= acc["at"]
        return F.struct(F.when(fits, x["stop"]).otherwise(acc["at"]).alias("at"), F.when(fits, F.concat(acc["chosen"], F.array(F.struct(x["start"].alias("start"), x["stop"].alias("stop"))))).otherwise(acc["chosen"]).alias("chosen"))

    return F.aggregate(ordered, start, step, lambda acc: acc["chosen"])
