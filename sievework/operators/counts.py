"""Counts of distinct things, and the thresholds that decide on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side, stash


def frequencies(rows: DataFrame, term: str, doc: str) -> DataFrame:
    """term, n, docs. Two plain aggregations, the first of which also sums the duplicates away before the distinct count."""
    return rows.groupBy(term, doc).agg(F.count("*").alias("k")).groupBy(term).agg(F.sum("k").alias("n"), F.count(doc).alias("docs"))


def attestations(rows: DataFrame, term: str, sentence: str, doc: str, text: str | None = None) -> DataFrame:
    """term, docs, attestations (distinct sentences), copy_factor, top_share; with a text column also top_sentence.

    sentence may be a digest: then no text travels with each of its words unless top_sentence (the least of those in most
    documents) is asked for, which is for small vocabularies.
    """
    extra = [text] if text else []
    once = rows.select(term, sentence, doc, *extra).distinct()
    per_sentence = once.groupBy(term, sentence).agg(F.count("*").alias("d"), *(F.min(t).alias("t") for t in extra))
    docs = once.select(term, doc).distinct().groupBy(term).agg(F.count("*").alias("docs"))
    top = [F.min(F.struct((-F.col("d")).alias("d"), "t")).alias("top")] if text else []
    out = per_sentence.groupBy(term).agg(F.count("*").alias("attestations"), F.max("d").alias("most"), *top).join(docs, term)
    columns = [term, "docs", "attestations", F.round(F.col("docs") / F.col("attestations"), 6).alias("copy_factor"), F.round(F.col("most") / F.col("docs"), 6).alias("top_share")]
    return out.select(*columns, *([F.col("top.t").alias("top_sentence")] if text else []))


def one_row_each(docs: DataFrame, doc: str) -> bool:
    """Whether no two rows have the same document and none has null; then its words needn't be met again to be counted once."""
    rows = docs.groupBy(doc).agg(F.count("*").alias("n"))
    return rows.where((F.col("n") > 1) | F.col(doc).isNull()).isEmpty()


def word_frequencies(docs: DataFrame, words: str, term: str, doc: str) -> DataFrame:
    """term, n, docs over an array of words of each document. Terms are added up where the documents lie, and only sums travel."""
    if not one_row_each(docs, doc):
        return frequencies(docs.select(doc, F.explode(words).alias(term)), term, doc)
    marked = lambda xs, k: F.transform(xs, lambda w: F.struct(w.alias("w"), F.lit(k).alias("k")))
    rows = docs.select(F.explode(F.concat(marked(F.col(words), 0), marked(F.array_distinct(words), 1))).alias("x"))
    return rows.groupBy(F.col("x.w").alias(term)).agg(F.count_if(F.col("x.k") == 0).alias("n"), F.count_if(F.col("x.k") == 1).alias("docs"))


def once_each(sentences: DataFrame, doc: str, text: str) -> DataFrame:
    """k (a digest), text, d for each distinct sentence: the documents that have it."""
    keyed = sentences.select(F.unhex(F.md5(text)).alias("k"), doc, text)
    return keyed.groupBy("k", doc).agg(F.first(text).alias(text)).groupBy("k").agg(F.first(text).alias(text), F.count(doc).alias("d"))


def attested(docs: DataFrame, words: str, sentences: DataFrame, text: str, of: Callable[[Column], Column], term: str, doc: str, once: DataFrame | None = None) -> DataFrame:
    """term, docs, attestations, copy_factor, top_share as from attestations, of whole vocabularies.

    A document that has a sentence has all its words, so a sentence is counted once for all of them: only distinct
    sentences are cut into words, which are added up where they lie. words: each document's, each once; of: a sentence's.
    """
    if one_row_each(docs, doc):
        held = docs.select(F.explode(words).alias(term)).groupBy(term).agg(F.count("*").alias("docs"))
    else:
        held = docs.select(doc, F.explode(words).alias(term)).distinct().groupBy(term).agg(F.count(doc).alias("docs"))
    once = once_each(sentences, doc, text) if once is None else once
    said = once.select("d", F.explode(F.array_distinct(of(F.col(text)))).alias(term))
    out = said.groupBy(term).agg(F.count("*").alias("attestations"), F.max("d").alias("most")).join(held, term)
    return out.select(term, "docs", "attestations", F.round(F.col("docs") / F.col("attestations"), 6).alias("copy_factor"), F.round(F.col("most") / F.col("docs"), 6).alias("top_share"), "most")


def suspects(docs: DataFrame, words: str, sentences: DataFrame, text: str, of: Callable[[Column], Column], term: str, doc: str, least: int = 3, copies: float = 3, share: float = 0.5) -> DataFrame:
    """term, docs, copy_factor, top_sentence (the least of those in most documents) of terms in `least` documents or more that copies carry."""
    once = stash(once_each(sentences, doc, text))
    rows = attested(docs, words, sentences, text, of, term, doc, once)
    held = small_side(rows.where(F.col("docs") >= least).where((F.col("copy_factor") >= copies) | (F.col("top_share") >= share)), 1_000_000)
    said = once.select("k", "d", F.explode(F.array_distinct(of(F.col(text)))).alias(term))
    # Digests meet the terms, and texts only the digests that are some term's top: no text travels with each of its words.
    top = said.join(held.select(term, F.col("most").alias("d")), [term, "d"]).select(term, "k")
    met = once.join(top.select("k").distinct(), "k", "left_semi").select("k", text)
    best = top.join(met, "k").groupBy(term).agg(F.min(text).alias("top_sentence"))
    return held.select(term, "docs", "copy_factor").join(best, term)


def repeated(rows: DataFrame, passage: str, doc: str, least: int) -> DataFrame:
    """passage, docs for those in at least so many documents."""
    return rows.select(passage, doc).distinct().groupBy(passage).agg(F.count("*").alias("docs")).where(F.col("docs") >= least)


def distinct_entities(assertions: DataFrame, tag: str, entity: str) -> DataFrame:
    return assertions.select(tag, entity).where(F.col(entity).isNotNull()).distinct().groupBy(tag).agg(F.count("*").alias("entities"))
