from pyspark.sql import functions as F

from sievework.operators.joins import join_one
from sievework.operators.order import running
from sievework.session import stash


def test_running_like_one_window(spark):
    rows = [(None if i % 5 == 0 else "hot" if i % 2 else "cold", i, i % 7) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, i int, x int")
    got = sorted((tuple(r) for r in running(df, ["g"], [F.desc("x"), F.col("i")], {"total": F.col("x")}).collect()), key=repr)
    want = []
    for g in (None, "hot", "cold"):
        total = 0
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1])), 1):
            total += r[2]
            want.append((*r, n, total))
    assert got == sorted(want, key=repr)
    assert running(df.limit(0), ["g"], [F.col("i")]).collect() == []


def test_hot_keys_join_like_others(spark):
    many = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(300)], "k int, i int")
    one = stash(many.groupBy("k").agg(F.count("*").alias("rows"), F.min("i").alias("least")))
    want = sorted(map(tuple, many.join(one, "k").collect()))
    for limits in ({}, {"hot": 10}, {"hot": 10, "most": 0}, {"hot": 0}):
        assert sorted(map(tuple, join_one(many, one, ["k"], **limits).collect())) == want
