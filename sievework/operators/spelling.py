"""Pairs of names that are spelt nearly alike, without comparing each name with every other.

Two names that are alike to a given degree have, in order, so many letters in common that leaving out a few of each
gives one and the same rest. Each name is filed under all rests of the sizes that this takes, and names meet that have
a rest in common. Where names of two lengths would take too many rests, they meet by pairs of letters: they share so many
that they share one of the rarest few of each. Names that meet are compared, exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import vectorized
from ..session import ship_package, stash

#: Degrees below this don't promise a shared pair of letters.
LEAST = 0.85
_CLOSE = 1e-9
#: Rests that a name may have of one size; beyond, names meet by pairs of letters.
MOST_RESTS = 2_000
#: Names longer than this meet by pairs of letters. Rests that are sent on together, about.
LONGEST, BATCH_RESTS = 100, 20_000


def _common(length: int, other: int, least: float, edits: bool) -> int:
    """How many letters two names of these lengths have in common at least, in order, if they are alike to that degree."""
    longer = max(length, other)
    return longer - math.floor((1 - least) * longer + _CLOSE) if edits else math.ceil(least * (length + other) / 2 - _CLOSE)


@cache
def _rest(length: int, other: int, least: float, edits: bool) -> int | None:
    """The size of the rests by which names of these lengths meet: 0 if they can't be alike, None if it would take too many."""
    size = _common(length, other, least, edits)
    if size > min(length, other):
        return 0
    return size if max(length, other) <= LONGEST and max(math.comb(length, size), math.comb(other, size)) <= MOST_RESTS else None


@cache
def _sizes(length: int, least: float, edits: bool) -> list[int]:
    """The sizes of the rests under which a name of this length is filed."""
    return sorted({_rest(length, other, least, edits) or 0 for other in range(length // 2, 2 * length + 1)} - {0}) if length <= LONGEST else []


def _by_rests(held: DataFrame, least: float, edits: bool) -> DataFrame:
    """a, b: names that have a rest in common, of the size that their lengths ask for."""
    fields = {"name": pa.string(), "size": pa.int32(), "rest": pa.string()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for size in _sizes(len(name), least, edits):
                    rests = {"".join(x) for x in combinations(name, size)}
                    for column, more in zip(out, ([name] * len(rests), [size] * len(rests), rests), strict=True):
                        column.extend(more)
                if len(out[0]) >= BATCH_RESTS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, fields.values(), strict=True)], names=list(fields))
                    out = [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, fields.values(), strict=True)], names=list(fields))

    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few names make many rests
    filed = stash(held.repartition(tasks, "name").mapInArrow(run, "name string, size int, rest string").select("name", "size", F.xxhash64("rest").alias("rest")))
    met = filed.join(filed.select(F.col("name").alias("b"), "size", "rest"), ["rest", "size"]).where(F.col("name") < F.col("b"))
    length, other = F.length("name"), F.length("b")
    longer = F.greatest(length, other)
    common = longer - F.floor((1 - least) * longer + _CLOSE) if edits else F.ceil(least * (length + other) / 2 - _CLOSE)
    return met.where(F.col("size") == common).select(F.col("name").alias("a"), "b")


def _shared(length: Column, other: Column, least: float, edits: bool) -> Column:
    """How many pairs of letters (with repeats) two names of these lengths share at least, if they are alike to that degree."""
    if edits:  # an edit spoils two pairs at most
        longer = F.greatest(length, other)
        return longer - 1 - 2 * F.floor((1 - least) * longer + _CLOSE)
    both = length + other
    matched = F.ceil(least * both / 2 - _CLOSE)
    return matched - (both - 2 * matched + 1)  # blocks are one more than letters left over, at most; each has a pair fewer than letters


def _ratio():  # type: ignore[no-untyped-def]
    from difflib import SequenceMatcher

    import pandas as pd

    def run(a, b, least):  # type: ignore[no-untyped-def]
        out: list[float | None] = []
        matcher, last = SequenceMatcher(None), None
        for x, y, at_least in zip(a, b, least, strict=True):
            if y != last:  # it keeps what it knows of the second name
                matcher.set_seq2(y)
                last = y
            matcher.set_seq1(x)
            out.append(matcher.ratio() if matcher.quick_ratio() >= at_least else None)
        return pd.Series(out)

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "least": pd.Series, "return": pd.Series}
    return vectorized("double")(run)


def _by_pairs(held: DataFrame, least: float, edits: bool) -> DataFrame:
    """a, b: names of fitting lengths that share one of the rarest pairs of letters of each."""
    size = F.length("name")
    pairs = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.substring(F.col("name"), i, F.lit(2)))
    numbered = held.select("name", pairs.alias("p")).select("name", F.transform("p", lambda x, i: F.concat(x, F.size(F.filter(F.slice("p", F.lit(1), i + 1), lambda y: y == x)).cast("string"))).alias("p"))
    tokens = stash(numbered.select("name", F.explode("p").alias("token")))
    common = tokens.groupBy("token").agg(F.count("*").alias("n"))
    ordered = tokens.join(common, "token").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("t"))
    shortest, longest = (F.ceil(size * least - _CLOSE), F.floor(size / least + _CLOSE)) if edits else (F.ceil(size * least / (2 - least) - _CLOSE), F.floor(size * (2 - least) / least + _CLOSE))
    shared = F.array_min(F.transform(F.sequence(shortest, longest), lambda other: _shared(size, other, least, edits)))
    filed = stash(ordered.select("name", size.alias("size"), shortest.alias("from"), longest.alias("to"), F.explode(F.slice("t", F.lit(1), F.greatest(F.lit(0), size - F.greatest(shared, F.lit(1))).cast("int"))).alias("t")).select("name", "size", "from", "to", "t.token"))
    other = filed.select(F.col("name").alias("b"), F.col("size").alias("size_b"), "token")
    return filed.join(other, "token").where((F.col("name") < F.col("b")) & F.col("size_b").between(F.col("from"), F.col("to"))).select(F.col("name").alias("a"), "b")


def near_spellings(names: DataFrame, name: str, least: float = 0.9, edits: bool = False) -> DataFrame:
    """a, b (a before b), score: pairs of different names of which at least that share agrees.

    The score is the share of letters in matching blocks, found longest first, or with edits 1 - edits / the longer length.
    Null names are left out and repeated ones count once; no name is equal to another, so names of one letter have none.
    """
    if not LEAST <= least <= 1:
        raise ValueError(f"degrees are {LEAST} to 1, not {least}")
    ship_package(names.sparkSession)
    held = stash(names.where(F.length(name) > 1).select(F.col(name).alias("name")).distinct())
    lengths = sorted(r["n"] for r in held.select(F.length("name").alias("n")).distinct().collect())  # no more than the longest name has letters
    short, long = [n for n in lengths if n <= LONGEST], [n for n in lengths if n > LONGEST]
    several = [n for n in short if any(_rest(n, m, least, edits) is None for m in [*short, *long[:1]])] + long
    met = _by_rests(held, least, edits)
    if several:
        met = met.unionByName(_by_pairs(held.where(F.length("name") >= several[0]), least, edits))
    met = met.distinct()
    if edits:
        longer = F.greatest(F.length("a"), F.length("b"))
        most = F.floor((1 - least) * longer + _CLOSE)
        scored = met.withColumn("e", F.levenshtein("a", "b")).where(F.col("e") <= most)
        return scored.select("a", "b", (1 - F.col("e") / longer).alias("score"))
    scored = met.sortWithinPartitions("b").withColumn("score", _ratio()(F.col("a"), F.col("b"), F.lit(least)))
    return scored.where(F.col("score") >= least)
