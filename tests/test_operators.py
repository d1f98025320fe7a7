import re

import pytest
from pyspark.sql import functions as F

from sievework.operators import dedupe, evaluation, features, graph, joins, quality
from sievework.operators.rules import SMELL_RULES, RuleSet, first_reason, is_named

SENTENCES = [
    "Linalool has a floral, woody odour.", "short", "x" * 400, "The odour value of linalool is high in this sample.", "It has no odor that could be noted, like limonene.",
    "Odor description of 4-isopropyl-2-methylcyclohex-2-en-1-one: spicy, herb.", "The floral note has a natural character throughout.", "KARANAL® possesses an ambery note that is quite dry.",
    "This compound was purified by reflux and has an odour.", "A more intense odour than that of citral is shown here.", "The mixture comprises an alcohol compound of sweet odour.", "Damascone imparts a rosy nuance to the whole blend.", "",
]


def python_reason(s, r: RuleSet):
    if not r.shortest < len(s) < r.longest:
        return "length"
    for pattern, label in r.exclude:
        if re.search(pattern, s):
            return label
    if not re.search(r.head, s):
        return r.missing[0]
    if not any(re.search(p, s) for p in r.attribution):
        return r.missing[1]
    named = any(re.search(p, s) for p in r.sure_names) or any(m.group().lower() not in r.stop for m in re.finditer(r.suffix_token, s))
    return "kept" if named else r.missing[2]


def test_rule_cascade_like_python(spark):
    df = spark.createDataFrame([(s,) for s in SENTENCES], "s string")
    got = {r.s: r.reason for r in df.select("s", first_reason("s", SMELL_RULES).alias("reason")).collect()}
    assert got == {s: python_reason(s, SMELL_RULES) for s in SENTENCES}
    assert len(set(got.values())) > 6
    assert df.where(is_named("s", SMELL_RULES)).count() > 3
    assert spark.createDataFrame([(None,)], "s string").select(first_reason("s", SMELL_RULES).alias("r")).first().r is None


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (5, 5), (7, None), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20), (2, 1)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 9, 10: 9, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20}
    chain = spark.range(0, 300).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in graph.components(chain).collect()} == {0}
    assert graph.components(chain.limit(0)).collect() == []


def test_duplicates(spark):
    long = lambda k: f"This is a sentence number {k} of more than forty characters."
    docs = {1: [1, 2, 3, 4], 2: [1, 2, 3], 3: [3, 2, 9], 4: [5], 5: [1, 2, 3, 4], 6: [4, 9]}
    rows = spark.createDataFrame([(d, long(k)) for d, ks in docs.items() for k in ks] + [(7, "short.")], "doc_id long, s string")
    posts = dedupe.postings(rows)
    assert posts.count() == sum(len(k) for k in docs.values())
    assert dedupe.postings(rows, most_docs=3).select("h").distinct().count() == 4
    got = {(r.a, r.b): r.score for r in dedupe.containment(posts).collect()}
    assert got == {(1, 2): 1.0, (1, 5): 1.0, (2, 5): 1.0}
    assert {r.doc: (r.component, r["size"]) for r in dedupe.groups(dedupe.containment(posts)).collect()} == {1: (1, 3), 2: (1, 3), 5: (1, 3)}


def test_carry_forward_keeps_splits(spark):
    candidates = spark.createDataFrame([("d", "s"), ("d", "t")], "source_id string, sentence string")
    decided = spark.createDataFrame([("d", "s", "approve", None), ("d", "s", "reject", 1), ("x", "gone", "approve", None)], "source_id string, sentence string, decision string, split_of int")
    out = [(r.sentence, r.decision, r.copy) for r in joins.carry_forward(candidates, decided, ["source_id", "sentence"], ["decision"], "split_of").orderBy("sentence", "copy").collect()]
    assert out == [("s", "approve", 1), ("s", "reject", 2), ("t", None, 1)]


def test_unambiguous(spark):
    rows = spark.createDataFrame([("a", "AAX"), ("a", "AAY"), ("b", "BBX"), ("b", "CCX")], "name string, identity string")
    got = {r["name"]: (r.verdict, r.pick) for r in joins.unambiguous(rows, "name", "identity", F.substring("identity", 1, 2)).collect()}
    assert got == {"a": ("accepted", "AAX"), "b": ("ambiguous", None)}


def test_edit_plan_refuses_other_counts(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k int, v string")
    edits = spark.createDataFrame([(1, 1, "new"), (2, 1, "new"), (3, 1, "new")], "k int, expected int, new string")
    got = sorted((r.k, r.v, r.note, r.edit_status) for r in joins.edit_plan(rows, edits, ["k"], "expected", "v", "new", "note").collect())
    assert got == [(1, "new", "was x", "applied"), (2, "y", None, "refused"), (2, "z", None, "refused")]


def test_quality_checks(spark):
    with pytest.raises(ValueError, match="several tags"):
        quality.vocabulary_map(spark.createDataFrame([("A", "x"), ("a ", "y")], "form string, tag string"))
    assert quality.vocabulary_map(spark.createDataFrame([("A", "x"), ("a", "x"), ("", "z")], "form string, tag string")).collect() == [("a", "x")]
    with pytest.raises(ValueError, match="failed"):
        quality.complete_only(spark.createDataFrame([(["w1"],)], "failed array<string>"), "failed")


def test_measures(spark):
    rows = spark.createDataFrame([(True, True), (True, False), (False, True), (True, True)], "got boolean, want boolean")
    r = evaluation.precision_recall(rows, F.col("got"), F.col("want")).first()
    assert (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1) == (2, 1, 1, 0.666667, 0.666667, 0.666667)
    empty = evaluation.precision_recall(rows.limit(0), F.col("got"), F.col("want")).first()
    assert (empty.precision, empty.recall, empty.f1) == (0, 0, 0)
    scored = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    assert features.auc(scored, "s", "y").first().auc == 0.75
    with pytest.raises(ValueError, match="points"):
        features.embed(spark.range(features.MOST_POINTS + 1).select("id", F.array(F.lit(1.0)).alias("v")), "id", "v")
