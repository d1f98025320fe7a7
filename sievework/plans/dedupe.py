"""Copies: exact, contained, in families; and what several documents share with a benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedupe as D
from ..session import table
from .base import SENTENCES_SQL, Plans, sentences


def exact_collapse(spark: SparkSession, d: str) -> DataFrame:
    """Distinct sentences with their sources and occurrences; the occurrences add up to the rows."""
    rows = sentences(spark, d).select(F.md5("s").alias("digest"), "doc_id", "source").groupBy("digest", "doc_id", "source").agg(F.count("*").alias("n"))
    # Digests travel, not texts; with the rows already grouped, of two distinct counts one is a sum unless a document has two sources.
    docs = rows.groupBy("digest", "doc_id").agg(F.sum("n").alias("n"), F.collect_set("source").alias("sources"))
    out = docs.groupBy("digest").agg(F.count("doc_id").alias("docs"), F.size(F.array_distinct(F.flatten(F.collect_set("sources")))).cast("long").alias("sources"), F.sum("n").alias("occurrences"))
    return out.where(F.col("occurrences") > 1).select("digest", "docs", "sources", "occurrences")


def predicate_sizes(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).where(F.length("s") > 40).agg(F.count("*").alias("rows"), F.countDistinct("s").alias("distinct_sentences"))


def posts(spark: SparkSession, d: str) -> DataFrame:
    return D.postings(sentences(spark, d))


def pairs(spark: SparkSession, d: str) -> DataFrame:
    return D.shared_pairs(posts(spark, d))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return D.containment(posts(spark, d))


def components(spark: SparkSession, d: str) -> DataFrame:
    return D.groups(edges(spark, d))


def histogram(spark: SparkSession, d: str) -> DataFrame:
    return components(spark, d).select("component", "size").distinct().groupBy("size").agg(F.count("*").alias("n"), F.sum(F.col("size") - 1).alias("redundant"))


def family_first(spark: SparkSession, d: str) -> DataFrame:
    """The first order of each customer: finished ones first, then by number; customers in the last tenth are unknown."""
    orders = table(spark, d, "orders")
    family = F.when(F.col("o_custkey") % 10 != 9, F.col("o_custkey"))
    return D.first_of(orders, family, [(F.col("o_orderstatus") != "F").asc(), F.col("o_orderkey").asc()], F.col("o_orderkey")).select("o_orderkey", "o_custkey")


def squash_duplicates(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select("lang", F.explode(F.array_distinct(T.words("text"))).alias("w")).where(F.rlike("w", F.lit("^[a-z]+$")))
    return words.groupBy("lang").agg(F.countDistinct("w").alias("printed"), F.countDistinct(T.squash("w")).alias("squashed"))


def benchmark_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a whole benchmark text, found by words of it rather than by comparing all with all.

    The first and the last word of a text may be parts of a document's words (a quote before it, a stop after it), so its
    key are up to `most` words between these, and documents are cut into runs of each length that occurs. A text of one
    or two words has none between and is looked for in every document.
    """
    most = 8
    norm = lambda t: t.select("*", T.collapse("text").alias("t")).select("*", F.split("t", " ").alias("w"))
    key = lambda at, n: F.xxhash64(F.array_join(F.slice("w", at, n), " "))
    runs = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: key(i, F.lit(n)))
    items = norm(table(spark, d, "benchmark")).where(F.col("t").isNotNull())
    items = items.select("item_id", F.col("t").alias("item"), "w", F.greatest(F.least(F.size("w") - 2, F.lit(most)), F.lit(0)).alias("n"))
    docs = norm(table(spark, d, "documents")).select("doc_id", "t", "w")
    held = F.contains("t", F.col("item"))
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())
    found = docs.join(items.where(F.col("n") == 0).select("item_id", "item"), held).select("item_id", "doc_id")
    if any(lengths):
        keyed = docs.select("doc_id", F.explode(F.array_distinct(F.flatten(F.array(*(runs(n) for n in lengths if n))))).alias("k"))
        # Keys alone are exploded and joined; texts come to the pairs that were found.
        pairs = keyed.join(items.where(F.col("n") > 0).select("item_id", key(F.lit(2), F.col("n")).alias("k")), "k").select("item_id", "doc_id").distinct()
        longer = pairs.join(items.select("item_id", "item"), "item_id").join(docs.select("doc_id", "t"), "doc_id").where(held).select("item_id", "doc_id")
        found = found.unionByName(longer) if 0 in lengths else longer
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("docs"))


GROUPS_SQL = rf"WITH RECURSIVE {SENTENCES_SQL}, o AS (SELECT DISTINCT doc_id, md5(s) AS h FROM s WHERE length(s) >= 40), r AS (SELECT h FROM o GROUP BY h HAVING count(*) <= 5), p AS (SELECT * FROM o WHERE h IN (SELECT h FROM r)), z AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id), q AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM p a JOIN p b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2), e AS (SELECT a, b, shared, round(shared::DOUBLE / least(za.n, zb.n), 6) AS score FROM q JOIN z za ON za.doc_id = a JOIN z zb ON zb.doc_id = b WHERE shared >= 3 AND shared::DOUBLE / least(za.n, zb.n) >= 0.6), u AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), c AS (SELECT x AS doc, x AS reached FROM u UNION SELECT c.doc, u.y FROM c JOIN u ON c.reached = u.x), g AS (SELECT doc, min(reached) AS component FROM c GROUP BY doc), k AS (SELECT doc, component, count(*) OVER (PARTITION BY component) AS size FROM g)"
PLANS: Plans = {
    "exact_dup_collapse": (exact_collapse, f"WITH {SENTENCES_SQL} SELECT md5(s) AS digest, count(DISTINCT doc_id) AS docs, count(DISTINCT source) AS sources, count(*) AS occurrences FROM s GROUP BY s HAVING count(*) > 1"),
    "rows_beside_distinct": (predicate_sizes, f'WITH {SENTENCES_SQL} SELECT count(*) AS "rows", count(DISTINCT s) AS distinct_sentences FROM s WHERE length(s) > 40'),
    "doc_pairs_shared_rare": (pairs, f"{GROUPS_SQL} SELECT * FROM q"),
    "containment_edges": (edges, f"{GROUPS_SQL} SELECT * FROM e"),
    "dup_components": (components, f"{GROUPS_SQL} SELECT * FROM k"),
    "dup_size_histogram": (histogram, f"{GROUPS_SQL} SELECT size, count(*) AS n, sum(size - 1)::BIGINT AS redundant FROM (SELECT DISTINCT component, size FROM k) GROUP BY size"),
    "family_first": (family_first, "WITH r AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN o_custkey % 10 <> 9 THEN o_custkey::VARCHAR ELSE '__' || o_orderkey::VARCHAR END ORDER BY o_orderstatus <> 'F', o_orderkey) AS r FROM orders) SELECT o_orderkey, o_custkey FROM r WHERE r = 1"),
    "squash_duplicates": (squash_duplicates, r"WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents) SELECT lang, count(DISTINCT w) AS printed, count(DISTINCT translate(w, 'loi', '101')) AS squashed FROM w WHERE regexp_matches(w, '^[a-z]+$') GROUP BY lang"),
    "benchmark_contamination": (benchmark_sentences, r"WITH b AS (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM benchmark), d AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents) SELECT item_id, count(DISTINCT doc_id) AS docs FROM b JOIN d ON contains(d.t, b.t) GROUP BY item_id"),
}
