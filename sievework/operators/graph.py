"""Connected components as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rounds after which the loop fails rather than return labels that may still change.
MOST_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the least node of its component) for every node of an edge between two different nodes.

    Each round points the neighbours of a node at the least of them, first the larger ones, then the smaller ones; the
    number of rounds grows with the logarithm of the number of nodes. Rounds are checkpointed in the shared folder, so
    lineage stays short. Edges with a null end, loops and repeated edges change nothing. Raises if it doesn't settle.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNull() | F.col(b).isNull() | (F.col(a) == F.col(b))).toDF("u", "v", "skip")
    now = now.where(~F.col("skip")).select("u", "v").distinct().checkpoint()
    seen = None
    for _ in range(MOST_ROUNDS):
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = sign
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = least.select("u", F.col("m").alias("v")).unionByName(small).distinct().checkpoint()
    raise RuntimeError(f"components didn't settle in {MOST_ROUNDS} rounds")
