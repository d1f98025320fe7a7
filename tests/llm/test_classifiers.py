import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import labelled, quality, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_toxicity(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.predictions(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.9


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = [r for r in quality.predictions(docs, labels).join(labels, "doc_id").collect() if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95


def test_counterfactual_term_takes_blame_from_identity_terms():
    rng = random.Random(5)
    rows, names = [], ["muslim", "christian", "vile", "kind"]
    swap = {0: 1, 1: 0}
    for _ in range(400):
        toxic = rng.random() < 0.5
        present = [2 if toxic else 3] if rng.random() < 0.5 else []
        present += [0] if toxic and rng.random() < 0.8 else [1] if rng.random() < 0.5 else []
        rows.append((sorted(present), sorted(swap.get(i, i) for i in present), int(toxic)))
    plain, fair = (toxicity.fit_rows(rows, names, c) for c in (0.0, toxicity.COUNTERFACTUAL))
    gap = lambda m: abs(m.scorer()("a muslim neighbour") - m.scorer()("a christian neighbour"))
    assert gap(plain) > 0.3 and gap(fair) < 0.05 and fair.scorer()("vile") > fair.scorer()("kind")


def test_swaps_stay_in_their_group():
    assert toxicity.swapped({"muslim", "tree"}) == {"christian", "tree"}
    assert toxicity.swapped(set()) == set()


SCHEMA = "doc_id long, text string, score string, y int"


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(spark, module):
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (2, "", "x", 1), (None, "word " * 30000, "x", 1), (4, "!!", "x", 1)], SCHEMA)
    label = "toxic" if module is toxicity else "quality"
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    got = module.predictions(docs, none).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    some = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (4, None), (77, 0)], f"doc_id long, {label} int")
    assert module.predictions(docs, some).count() == 5
    assert module.predictions(docs.limit(0), some).collect() == []


def test_rejection_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a", "b", 2)], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.reject(docs, labels, threshold=0.6)
    assert out.columns == docs.columns and out.collect() == docs.collect()


def test_ranking_learns_an_order():
    x = np.random.default_rng(1).normal(size=(300, len(quality.FEATURES)))
    y = (x[:, 0] > -1).astype(int)
    scores = quality.fit_rows(x, y).score(x)
    assert ((scores >= quality.THRESHOLD) == (y == 1)).mean() > 0.95
    assert len(quality.describe("")) == len(quality.FEATURES)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_do_not_depend_on_how_rows_are_dealt_out(spark, module):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    one, seven = (module.fit(docs.repartition(n, "text"), labels.repartition(n)) for n in (1, 7))
    assert one == seven


def test_training_rows_are_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {n}") for n in range(500)] + [(1, "text 3"), (2, None), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1)], "doc_id long, toxic int").where(~labelled.held_out(F.col("doc_id")))
    every = labelled.training_rows(docs, labels, "toxic", 10).collect()
    assert len(every) == labels.select("doc_id").distinct().count()
    assert labelled.training_rows(docs, labels, "toxic", 1).count() == 1
    assert labelled.training_rows(docs.limit(0), labels, "toxic", 10).collect() == []


def test_quality_fit_like_a_plain_one():
    """The loss over pairs as written down has no slope where the fit ends, and plain descent finds no lesser one."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(24, len(quality.FEATURES)))
    y = (x[:, 0] + 0.3 * rng.normal(size=24) > -0.3).astype(int)
    z = quality.wide(np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6), -8, 8))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    left = np.random.default_rng(5).choice(good, len(bad) * quality.PAIRS)
    pairs = [z[a] - z[b] for a, b in zip(left, np.repeat(bad, quality.PAIRS), strict=True)]

    def loss(w):
        return sum(np.log1p(np.exp(-(d @ w))) for d in pairs) / len(pairs) + quality.RIDGE / 2 * (w @ w)

    w = np.zeros(z.shape[1])
    for _ in range(2000):
        w -= 0.05 * (sum(-d / (1 + np.exp(d @ w)) for d in pairs) / len(pairs) + quality.RIDGE * w)
    model = quality.fit_rows(x, y)
    fitted = np.array(model.weights)
    slope = sum(-d / (1 + np.exp(d @ fitted)) for d in pairs) / len(pairs) + quality.RIDGE * fitted
    assert np.abs(slope).max() < 1e-3 and loss(fitted) <= loss(w) + 1e-6
    strength = z @ fitted
    assert ((model.score(x) >= quality.THRESHOLD) == (strength >= np.quantile(strength, (y == 0).mean()) - 1e-9)).all()


def test_toxicity_fit_like_a_plain_one():
    """The loss as written down, minimised by plain gradient descent on dense matrices."""
    rng = random.Random(6)
    rows = []
    for _ in range(60):
        y = rng.random() < 0.5
        a = sorted({rng.randrange(5) for _ in range(2)} | ({3} if y and rng.random() < 0.7 else set()))
        rows.append((a, sorted({1 if i == 0 else 0 if i == 1 else i for i in a}), int(y)))
    x = np.array([[float(i in r[0]) for i in range(5)] + [1.0] for r in rows])
    d = np.array([[float(i in r[0]) - float(i in r[1]) for i in range(5)] + [0.0] for r in rows if r[0] != r[1]])
    y, ridge = np.array([r[2] for r in rows]), np.array([toxicity.RIDGE] * 5 + [1e-6])

    def loss(w):
        change = toxicity.COUNTERFACTUAL / len(d) * sum((row @ w) ** 2 for row in d)
        return sum(np.log1p(np.exp(-(row @ w) * (2 * t - 1))) for row, t in zip(x, y, strict=True)) / len(y) + (ridge * w) @ w / 2 + change

    def slope(w):
        return x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + ridge * w + 2 * toxicity.COUNTERFACTUAL / len(d) * d.T @ (d @ w)

    w = np.zeros(6)
    for _ in range(20000):
        w -= 0.02 * slope(w)
    model = toxicity.fit_rows(rows, list("abcde"))
    fitted = np.array([model.weights.get(n, 0.0) for n in "abcde"] + [model.bias])
    assert np.abs(slope(fitted)).max() < 1e-3 and loss(fitted) <= loss(w) + 1e-4


def test_a_column_named_like_the_score(spark):
    docs = spark.createDataFrame([(n, f"{'vile' if n % 2 else 'kind'} text {n}", 1.0, "x") for n in range(60)], "doc_id long, text string, _toxicity double, _Toxicity_ string")
    labels = docs.selectExpr("doc_id", "doc_id % 2 AS toxic")
    out = toxicity.reject(docs, labels)
    assert out.columns == docs.columns and 0 < out.count() < 60


def test_mentions_are_made_of_labelled_sentences_and_bind(spark):
    """Counterfactual pairs exist where no text names a group, and naming one or another moves no score of the given data."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = docs.join(labels.where("toxic is not null"), "doc_id").limit(200).collect()
    assert all(len(toxicity.mentions(r.text)) == len(toxicity.CARRIERS) and all(a != b for a, b in toxicity.mentions(r.text)) for r in rows)
    score = toxicity.fit(docs, labels).scorer()
    for r in rows[:60]:
        for carrier, heads in toxicity.CARRIERS.items():
            for head in heads:
                said = [score(f"{r.text} {carrier.format(t)}") for t in toxicity._GROUP[head]]
                assert max(said) - min(said) < 0.05


def test_mentions_unlearn_a_slur_by_association(spark):
    """One term of a group stands in toxic texts only: with the regulariser its swap moves neutral sentences far less."""
    rows = []
    for i in range(400):
        toxic = i % 2
        rows.append((i, f"text {i % 7} was said by a {'muslim' if toxic and i % 4 == 1 else 'christian'} person {'awful' if toxic and i % 3 else 'fine'}", toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = df.select("doc_id", "text"), df.select("doc_id", "toxic")
    gap = {}
    for strength in (0.0, toxicity.COUNTERFACTUAL):
        score = toxicity.fit(docs, labels, counterfactual=strength).scorer()
        gap[strength] = abs(score("it was said by a muslim person") - score("it was said by a christian person"))
    assert gap[0.0] > 0.2 and gap[toxicity.COUNTERFACTUAL] < 0.1 * gap[0.0]


def test_mentions_of_texts_without_words():
    assert all(a and b for a, b in toxicity.mentions("")) and toxicity.mentions("... 12") == toxicity.mentions("... 12")
