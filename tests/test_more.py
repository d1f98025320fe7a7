import pytest
from pyspark.sql import functions as F

from sievework.functions import identifiers as N
from sievework.operators import quality
from sievework.sources import readers, sinks


def test_stamps_and_maps(spark):
    row = spark.range(1).select(N.utc_stamp(F.lit("2024-01-02 03:04:05").cast("timestamp")).alias("t"), N.hours_left(F.lit(3600), 4.0).alias("h"), N.renamed_keys(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), {"a": "x"}).alias("m")).first()
    assert (row.t, row.h, row.m) == ("2024-01-02T03:04:05Z", 2.0, {"x": 1, "b": 2})


def test_known_terms(spark):
    forms = spark.createDataFrame([("floral",), ("fruity",), ("green",)], "form string")
    assert quality.known_terms(["floral"], forms, "form") == ["floral"]
    with pytest.raises(ValueError, match="florl.*floral"):
        quality.known_terms(["florl", "green"], forms, "form")


def test_sections(spark):
    rows = spark.createDataFrame([("b", 2, "y"), ("b", 1, "x"), ("a", 1, "z")], "g string, n int, t string")
    got = {r.g: r.section for r in sinks.markdown_sections(rows, "g", F.col("t"), ["n"]).collect()}
    assert got == {"a": "## a\n\n- z\n", "b": "## b\n\n- x\n- y\n"}


def test_prefixes(spark):
    rows = spark.createDataFrame([(x,) for x in ["a", "ab1", "ab1", "ab2", "ac", "b", None]], "k string")
    got = sorted(tuple(r) for r in readers.split_prefixes(rows, "k", 2, 3).collect())
    assert got == [("a", 1, "ok"), ("ab1", 2, "failed"), ("ab2", 1, "ok"), ("ac", 1, "ok"), ("b", 1, "ok")]
    assert sum(n for _, n, _ in got) == 6
