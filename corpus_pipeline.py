"""A corpus from documents to token ids: each stage calls one operator and works on all that the one before kept.

toxicity: documents that score 0.5 or more go. near_duplicates: of each group of SimHash near copies (five-word
shingles, similarity 0.8 or more) the document with the least doc_id stays. decontamination: documents of which benchmark windows cover a twentieth or more go. secrets:
secrets in texts are masked. bpe: texts become token ids. Nulls, empty texts, repeated rows and empty tables have the
results that the operators define; columns beyond those of documents are left out at the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import bpe, decontamination, secrets, simhash
from sievework.llm import toxicity as toxic
from sievework.session import ship_package, stash, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxic.reject(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return secrets.redact(docs.select(*COLUMNS))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, n_tokens, ids (packed, four little-endian bytes each), round_trip."""
    ship_package(spark)
    out = bpe.encode(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, COLUMNS)
    same = F.col("decoded").eqNullSafe(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return out.select(*COLUMNS, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("secrets", secret_scan),
    ("bpe", bpe_encode),
]

#: The classifier and the SimHash fingerprints have no SQL form; the tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written as Parquet beside the checkpoints before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stash(docs)
    return docs
