"""Labelled rows: which are held out, and a bounded sample of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(key: Column) -> Column:
    """crc32 of the key as text, mod 5, is 0. A null key isn't held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Up to `most` labelled rows outside the held-out fold, least hash first: text, y.

    Null labels and null keys take no part; a key that is labelled twice counts once, with its greatest label; a key with
    several rows counts once, with the text of least hash. So there are no more rows than the bound, and the same ones
    however the tables are dealt out. The labels' rows are cut before the join: what is broadcast is bounded too.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
        .select(F.col("doc_id").alias("_key"), "_y")
    )
    text = F.coalesce(docs["text"], F.lit(""))
    met = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_key"]).select("_key", F.struct(F.xxhash64(text).alias("hash"), text.alias("text"), F.col("_y").alias("y")).alias("row"))
    return met.groupBy("_key").agg(F.min("row").alias("row")).select("row.text", "row.y")
