"""Duplicate documents by shared rare sentences, families, and first-of-group picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components


def postings(sentences: DataFrame, doc: str = "doc_id", s: str = "s", shortest: int = 40, most_docs: int = 5) -> DataFrame:
    """doc, h: hashes of a document's distinct sentences that aren't boilerplate, that is, in more than `most_docs` documents."""
    once = sentences.where(F.length(s) >= shortest).select(doc, F.md5(s).alias("h")).distinct()
    rare = once.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") <= most_docs).select("h")
    return once.join(rare, "h")


def shared_pairs(posts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """a, b, shared: documents with a rare sentence in common. A sentence is in few documents, so its pairs are few."""
    a, b = posts.select(F.col(doc).alias("a"), "h"), posts.select(F.col(doc).alias("b"), "h")
    return a.join(b, "h").where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count("*").alias("shared"))


def containment(posts: DataFrame, doc: str = "doc_id", least_shared: int = 3, threshold: float = 0.6) -> DataFrame:
    """a, b, shared, score for pairs whose shared sentences are at least the threshold of the smaller document's rare ones."""
    size = posts.groupBy(doc).agg(F.count("*").alias("n"))
    pairs = shared_pairs(posts, doc).where(F.col("shared") >= least_shared)
    pairs = pairs.join(size.select(F.col(doc).alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col(doc).alias("b"), F.col("n").alias("nb")), "b")
    score = F.col("shared") / F.least("na", "nb")
    return pairs.select("a", "b", "shared", F.round(score, 6).alias("score")).where(score >= threshold)


def groups(edges: DataFrame) -> DataFrame:
    """doc, component (its least document), size."""
    found = components(edges, "a", "b").select(F.col("node").alias("doc"), F.col("root").alias("component"))
    return found.join(found.groupBy("component").agg(F.count("*").alias("size")), "component").select("doc", "component", "size")


def first_of(rows: DataFrame, group: Column, order: list[Column], single: Column) -> DataFrame:
    """The first row of each group; a row without a group is a group of its own."""
    w = Window.partitionBy(F.coalesce(group.cast("string"), F.concat(F.lit("__"), single.cast("string")))).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
