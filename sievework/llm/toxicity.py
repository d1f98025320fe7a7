"""Toxicity scores by a counterfactually regularised linear classifier.

Features are the presence of words and of word beginnings, chosen by how strongly they go with the label among the
training rows. Besides the usual logistic loss, training swaps identity terms for others of their group, those that a
text has and those of mentions put into one of its sentences, and penalises the square of the change in score (before it
is squeezed to 0 to 1), so that naming a group doesn't count as toxic by itself.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import map_blocks, unused
from .labelled import held_out, training_rows
from .linear import minimise, sigmoid

WORD = re.compile(r"[^\W\d_]+")
SENTENCE_END = re.compile(r"[.!?\n]+")
#: Lengths of the word beginnings that are features beside whole words.
STEMS = (4, 5, 6)
#: Bound of the training sample, and of the features kept.
TRAINING_ROWS, FEATURES = 10_000, 1_024
#: A feature must be in so many training rows, and its share must differ by so many standard errors between the labels.
LEAST_ROWS, LEAST_Z = 5, 5.0
#: Weights of the squared weights and of the squared counterfactual changes in the loss.
RIDGE, COUNTERFACTUAL = 2e-4, 10.0
MEMO_WORDS = 100_000

# Terms that name groups of people, by kind of group.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "nonbinary", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "deaf", "blind", "autistic"),
    ("young", "old", "elderly"),
    ("musulmane", "chrétienne", "juive", "hindoue", "bouddhiste", "athée"),
    ("noire", "blanche", "asiatique", "arabe", "africaine", "européenne"),
    ("handicapée", "sourde", "aveugle", "autiste"),
    ("homosexuelle", "lesbienne", "bisexuelle", "hétérosexuelle"),
    ("immigrée", "réfugiée", "étrangère"),
    ("muslimische", "christliche", "jüdische", "hinduistische", "buddhistische", "atheistische"),
    ("schwarze", "weiße", "asiatische", "arabische", "afrikanische", "europäische"),
    ("behinderte", "gehörlose", "blinde", "autistische"),
    ("schwule", "lesbische", "bisexuelle", "heterosexuelle"),
    ("eingewanderte", "geflüchtete", "ausländische"),
    ("musulmana", "cristiana", "judía", "hindú", "budista", "atea"),
    ("negra", "blanca", "asiática", "árabe", "africana", "europea"),
    ("discapacitada", "sorda", "ciega", "autista"),
    ("homosexual", "lesbiana", "bisexual", "heterosexual"),
    ("inmigrante", "refugiada", "extranjera"),
)
# Neutral mentions, and a term of each group that they take.
CARRIERS = {
    "said by a {} person": ("muslim", "gay", "black", "disabled", "young"),
    "dit par une personne {}": ("musulmane", "noire", "handicapée", "homosexuelle", "immigrée"),
    "gesagt von einer {} Person": ("muslimische", "schwarze", "behinderte", "schwule", "eingewanderte"),
    "dicho por una persona {}": ("musulmana", "negra", "discapacitada", "homosexual", "inmigrante"),
}
_GROUP = {t: g for g in IDENTITY_TERMS for t in g}


def features_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def swapped(words: set[str]) -> set[str]:
    """Each identity term gives way to the next one of its group."""
    return {g[(g.index(w) + 1) % len(g)] if (g := _GROUP.get(w)) else w for w in words}


def mentions(text: str) -> list[tuple[set[str], set[str]]]:
    """One sentence of the text, drawn by its hash, with a neutral mention of a group in each language: its words with one term and with another of its group.

    Texts name groups too seldom to learn from, or never; so the mention is put in, and the swap is made there.
    """
    draw = zlib.crc32(text.encode())
    own = [w for s in SENTENCE_END.split(text) if (w := words_of(s))]
    sentence = own[draw % len(own)] if own else set()
    out = []
    for at, (carrier, heads) in enumerate(CARRIERS.items()):
        draw = zlib.crc32(b"%d %d" % (draw, at))
        group = _GROUP[heads[draw % len(heads)]]
        first = draw // 8 % len(group)
        second = (first + 1 + draw // 64 % (len(group) - 1)) % len(group)
        out.append((sentence | words_of(carrier.format(group[first])), sentence | words_of(carrier.format(group[second]))))
    return out


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    #: False where there were no labelled rows to fit on.
    fitted: bool = True

    def scorer(self) -> Any:
        known: dict[str, tuple[str, ...]] = {}
        weights = self.weights

        def score(text: str) -> float:
            hit: set[str] = set()
            for word in words_of(text):
                found = known.get(word)
                if found is None:
                    if len(known) >= MEMO_WORDS:
                        known.clear()
                    found = known[word] = tuple(f for f in features_of(word) if f in weights)
                if found:
                    hit.update(found)
            return 1 / (1 + math.exp(-max(-35.0, min(35.0, self.bias + sum(weights[f] for f in sorted(hit))))))

        return score


class _Rows:
    """A matrix of zeros and ones, given as the columns of the ones in each row. Sums run in a fixed order."""

    def __init__(self, ones: list[list[int]], width: int) -> None:
        self.row = np.repeat(np.arange(len(ones)), [len(r) for r in ones])
        self.column = np.array([c for r in ones for c in r], np.int64)
        self.height, self.width = len(ones), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.height)

    def sums(self, of_rows: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, of_rows[self.row], self.width)


def fit_rows(rows: list[tuple[list[int], list[int], int]], names: list[str], counterfactual: float = COUNTERFACTUAL, pairs: Iterable[tuple[list[int], list[int]]] = ()) -> Model:
    """rows: features present, features present after the swap, label; pairs: features of a mention and of its swap."""
    n, size = len(rows), len(names)
    x = _Rows([[*r[0], size] for r in rows], size + 1)
    swaps = [(sorted(set(a) - set(b)), sorted(set(b) - set(a))) for a, b in [*((r[0], r[1]) for r in rows), *pairs]]
    swaps = [s for s in swaps if s[0] or s[1]]
    # each different swap weighs alike, however seldom it is drawn
    strength = 2 * counterfactual * len({(*min(s), -1, *max(s)) for s in swaps}) / max(len(swaps), 1)
    here, there = _Rows([a for a, _ in swaps], size + 1), _Rows([b for _, b in swaps], size + 1)
    y = np.array([r[2] for r in rows], float)
    weight = np.full(n, 1 / max(n, 1))
    ridge = np.full(size + 1, RIDGE)
    ridge[size] = 1e-6

    def changes(w: np.ndarray) -> np.ndarray:
        moved = here.dot(w) - there.dot(w)
        return here.sums(moved) - there.sums(moved)

    def gradient(w: np.ndarray) -> np.ndarray:
        return x.sums((sigmoid(x.dot(w)) - y) * weight) + ridge * w + strength * changes(w)

    # a diagonal above the curvature gives every weight a step of its own
    one = np.ones(size + 1)
    of_swaps = here.dot(one) + there.dot(one)
    scale = 1 / np.sqrt(0.25 * x.sums(x.dot(one) * weight) + strength * (here.sums(of_swaps) + there.sums(of_swaps)) + ridge)
    w = scale * minimise(lambda u: scale * gradient(scale * u), size + 1, 1.0)
    return Model({f: float(v) for f, v in zip(names, w[:size], strict=True) if v}, float(w[size]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", counterfactual: float = COUNTERFACTUAL, most: int = TRAINING_ROWS) -> Model:
    """A model from up to `most` labelled rows outside the held-out fold.

    Feature counts are summed by the executors; the driver gets FEATURES names and, for each training row, the numbers
    of those present. Without labelled rows the model scores 0.5 for all texts.
    """
    rows = training_rows(docs, labels, label, most).persist()

    def words() -> Any:
        def work(texts: list[str], ys: list[int]) -> list[list]:
            return [[sorted({f for w in words_of(t) for f in features_of(w)}) for t in texts], ys]

        return work

    try:
        found = map_blocks(rows, words, "f array<string>, y int", 0)
        total = rows.groupBy().agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
        n, p = total["n"], total["p"] or 0
        if not n:
            return Model({}, 0.0, fitted=False)
        with_label, without = F.col("a") / max(p, 1), F.col("b") / max(n - p, 1)
        pooled = (F.col("a") + F.col("b") + 1) / (n + 2)
        z = F.abs(with_label - without) / F.sqrt(pooled * (1 - pooled) * (1 / max(p, 1) + 1 / max(n - p, 1)))
        counts = found.select(F.explode("f").alias("f"), "y").groupBy("f").agg(F.sum("y").cast("long").alias("a"), F.sum(1 - F.col("y")).cast("long").alias("b")).where(F.col("a") + F.col("b") >= LEAST_ROWS)
        terms = sorted({f for t in _GROUP for f in features_of(t)})
        names = [r["f"] for r in counts.where(z >= LEAST_Z).orderBy(z.desc(), "f").limit(FEATURES).collect()]
        names = sorted({*names, *terms})
        number = {f: i for i, f in enumerate(names)}

        def present() -> Any:
            def of(words: set[str]) -> list[int]:
                return sorted({number[f] for w in words for f in features_of(w) if f in number})

            def work(texts: list[str], ys: list[int]) -> list[list]:
                every = [words_of(t) for t in texts]
                swaps = [[(set(of(a)), set(of(b))) for a, b in mentions(t)] for t in texts]
                only = lambda k: [[sorted(p[k] - p[1 - k]) for p in own] for own in swaps]
                return [[of(w) for w in every], [of(swapped(w)) for w in every], ys, only(0), only(1)]

            return work

        got = map_blocks(rows, present, "a array<int>, b array<int>, y int, c array<array<int>>, d array<array<int>>", 0).collect()
        # Rows come in any order; sums shall not depend on it.
        pairs = sorted(p for r in got for p in zip(r["c"], r["d"], strict=True))
        return fit_rows(sorted((r["a"], r["b"], r["y"]) for r in got), names, counterfactual, pairs)
    finally:
        rows.unpersist()


def score(df: DataFrame, model: Model, columns: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The named columns and, under another name, the score (0 to 1) for each row; a null text counts as empty and gets the bias alone."""

    def make() -> Any:
        own = model.scorer()

        def work(*out: list) -> list[list]:
            return [*out[:-1], [own(t) for t in out[-1]]]

        return work

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    return map_blocks(df.select(*(df[f"`{c}`"] for c in columns), F.col(text).alias("_scored")), make, f"{fields}, `{name}` double", len(columns))


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for each row. Null texts count as empty; repeated rows stay."""
    out = score(docs, fit(docs, labels), ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with all their columns; all rows if no labelled one lies outside the held-out fold."""
    names, model = docs.columns, fit(docs, labels)
    if not model.fitted:
        return docs
    own = unused("_toxicity", names)
    return score(docs, model, names, name=own).where(F.col(own) < threshold).select(*(F.col(f"`{c}`") for c in names))
