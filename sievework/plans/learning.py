"""Tags learnt from features of documents, tried on folds that weren't seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..session import table
from .base import Plans

_CLASSES = {"letters": r"\p{L}", "capitals": r"\p{Lu}", "digits": r"\p{N}", "spaces": r"\s", "lines": r"\n", "stops": r"[.!?]", "cries": "!", "commas": ",", "signs": r"[^\p{L}\p{N}\s]", "long_words": r"\p{L}{9,}", "short_words": r"\b\p{L}{1,3}\b"}


def text_features() -> dict[str, Column]:
    """Counts of kinds of characters and words, most of them for each character of the text."""
    size = F.greatest(F.length("text"), F.lit(1))
    return {"chars": F.length("text").cast("double"), **{k: F.regexp_count("text", F.lit(p)) / size for k, p in _CLASSES.items()}}


def labelled(spark: SparkSession, d: str) -> DataFrame:
    made = text_features()
    rows = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality", "toxic"), "doc_id")
    return rows.select("doc_id", "quality", "toxic", *(v.alias(k) for k, v in made.items()))


def tag_models(spark: SparkSession, d: str) -> DataFrame:
    """How well each tag can be told from the features, by boosted trees on five folds."""
    scored = B.cross_scores(labelled(spark, d), "doc_id", list(text_features()), ["quality", "toxic"], F.col("doc_id") % B.FOLDS)
    return B.rank_measure(scored, ["tag"], "score", "label").select("tag", "n", "positives", F.round("auc", 6).alias("auc"))


def length_ranks(spark: SparkSession, d: str) -> DataFrame:
    """The measure alone, by source: how well a text's length ranks its quality."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels").where("quality is not null").select("doc_id", "quality"), "doc_id")
    return B.rank_measure(rows.withColumn("score", F.length("text")), ["source"], "score", "quality").select("source", "n", "positives", F.round("auc", 9).alias("auc"))


PLANS: Plans = {
    "tag_models": (tag_models, None),
    "length_ranks": (
        length_ranks,
        "WITH r AS (SELECT source, length(text) AS s, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL), c AS (SELECT source, s, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS q FROM r GROUP BY source, s), "
        "w AS (SELECT *, sum(q) OVER (PARTITION BY source ORDER BY s) - q AS before FROM c), t AS (SELECT source, sum(p + q)::BIGINT AS n, sum(p)::BIGINT AS positives, sum(q) AS qs, sum(p * (2 * before + q)) AS won FROM w GROUP BY source) "
        "SELECT source, n, positives, CASE WHEN positives > 0 AND qs > 0 THEN round(won::DOUBLE / (2 * positives * qs)::DOUBLE, 9) END AS auc FROM t",
    ),
}
