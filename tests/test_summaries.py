"""Operators of hit tables and samples on rows with nulls, ties and nothing in them."""

from pyspark.sql import functions as F

from sievework.functions import identifiers as N
from sievework.operators import evaluation, joins
from sievework.sources import readers, sinks


def test_terms_that_would_cross(spark):
    forms = spark.createDataFrame([("rosy", 1), ("rosy", 2), ("rosewood", 3), ("musk", 1), ("", 5)], "w string, e int")
    tagged = spark.createDataFrame([("rose", 1), ("rose", 9), ("rosy", 2), ("green", 1)], "tag string, e int")
    got = sorted(tuple(r) for r in joins.would_cross(forms, "w", tagged, "tag", "e", 3).collect())
    assert got == [("rosewood", 1, "rose", 2, 3, True), ("rosy", 2, "rosy", 1, 2, False)]
    assert joins.would_cross(forms.limit(0), "w", tagged, "tag", "e", 3).count() == 0


def test_hit_summary(spark):
    fields = "n string, d int, p int, t string, c boolean, s string, tags array<string>"
    rows = [("a", 1, 1, "than x", True, "approve", ["sweet"]), ("a", 1, 2, "late", False, None, ["sweet", "rose"]), ("a", 1, 0, "early", None, None, ["rose"]), ("a", 2, 0, "other", False, "reject", None), ("b", 1, 0, "than", True, None, ["rose"])]
    out = joins.hit_summary(spark.createDataFrame(rows, fields), "n", "d", "p", "t", "c", "s", "tags", cut=4)
    got = {r.n: tuple(r)[1:] for r in out.collect()}
    assert got == {"a": (4, 2, 3, 2, "approve:1;reject:1;undecided:2", "rose 2, sweet 1", "earl"), "b": (1, 1, 0, 0, "undecided:1", "", None)}


def test_agreement(spark):
    fields = "want boolean, got boolean, a array<string>, b array<string>"
    rows = [(True, True, ["X", "y"], ["Y", "x", "x"]), (True, True, ["x"], ["z"]), (False, False, [], []), (True, False, [], []), (None, True, None, None)]
    row = evaluation.agreement(spark.createDataFrame(rows, fields), "want", "got", F.col("a"), F.col("b")).first()
    assert tuple(row) == (5, 3, 2, 0.5, 2, 1)
    assert tuple(evaluation.agreement(spark.createDataFrame([], fields), "want", "got", F.col("a"), F.col("b")).first()) == (0, 0, 0, 0.0, 0, 0)


def test_years_of_prefixes(spark):
    rows = [("a", 1992)] * 2 + [("b", 1993)] * 2 + [("b", 1995)] * 3 + [("b", 1997)] + [("c", 1992)] * 4
    got = sorted((tuple(r) for r in readers.split_years(spark.createDataFrame(rows, "p string, y int"), "p", "y", 4, 1992).collect()), key=repr)
    assert got == [("a", None, None, 2, "ok"), ("b", 1992, 1994, 2, "ok"), ("b", 1995, 1995, 3, "ok"), ("b", 1997, 1997, 1, "ok"), ("c", 1992, 1992, 4, "failed")]


def test_molecules_that_cant_be_read():
    assert N.descriptors_of("C1CC") is None and N.descriptors_of("C(C") is None and N.descriptors_of("1CC") is None and N.descriptors_of("Xx") is None
    assert N.descriptors_of("")[0] == 0
    assert dict(zip(N.DESCRIPTORS, N.descriptors_of("C1CC2CCC1CC2"), strict=False))["rings"] == 2
    assert N.formula_of("[NH4+]") == ("H4N", 18.039)


def test_an_existing_version_is_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    root = str(tmp_path / "v")
    assert [sinks.write_version(df, root)[-3:] for _ in range(2)] == ["v=1", "v=2"]
    assert sorted(p.name for p in (tmp_path / "v").iterdir() if not p.name.startswith(".")) == ["v=1", "v=2"]
