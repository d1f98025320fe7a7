"""Entities per tag: which assertions are admitted, under which identity they are counted, and which tags reach the bar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.counts import distinct_entities
from ..session import table
from .base import VOCABULARY_SQL, Plans, vocabulary

BAR, NEAR = 30, 20


def assertions(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, kind, decision, tag, name, block, full: a row for each document and tag of the vocabulary in it."""
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("lang") == "en", "review").when(F.col("lang") == "fr", "database").when(F.col("lang") == "de", "passage").otherwise("licensed").alias("kind"), "source", "lang", F.explode(F.array_distinct(T.words("text"))).alias("w"))
    tagged = docs.join(F.broadcast(vocabulary(spark)), F.col("w") == F.col("form")).select("doc_id", "kind", "source", "lang", "tag").distinct()
    decided = tagged.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    name = F.concat(F.lit("m"), F.pmod("doc_id", F.lit(61)).cast("string"))
    return decided.select("doc_id", "kind", F.when(F.col("quality") == 1, "approve").when(F.col("quality") == 0, "reject").alias("decision"), "tag", name.alias("name"), F.concat(name, F.col("lang")).alias("block"), F.concat(name, F.col("lang"), F.col("source")).alias("full"))


def admitted(spark: SparkSession, d: str) -> DataFrame:
    """Reviewed rows need approval; the others are in unless they were rejected. A null decision isn't a rejection."""
    return assertions(spark, d).where(F.when(F.col("kind") == "review", F.col("decision").eqNullSafe("approve")).otherwise(~F.col("decision").eqNullSafe("reject")))


def per_tag(spark: SparkSession, d: str) -> DataFrame:
    return distinct_entities(admitted(spark, d), "tag", "name")


def at_bar(spark: SparkSession, d: str) -> DataFrame:
    return per_tag(spark, d).where(F.col("entities") >= BAR)


def near_bar(spark: SparkSession, d: str) -> DataFrame:
    return distinct_entities(admitted(spark, d).where(F.col("kind") == "licensed"), "tag", "name").where(F.col("entities").between(NEAR, BAR - 1))


def shortfall(spark: SparkSession, d: str, of: str) -> DataFrame:
    have = distinct_entities(admitted(spark, d).where(F.col("kind") == "licensed"), "tag", "name")
    wanted = vocabulary(spark) if of == "forms" else vocabulary(spark).select("tag").distinct()
    return wanted.join(have, "tag", "left").agg(F.sum(F.greatest(F.lit(0), BAR - F.coalesce("entities", F.lit(0)))).cast("long").alias(f"shortfall_{of}"))


def three_granularity(spark: SparkSession, d: str) -> DataFrame:
    """Distinct entities of each source and of all together, by full key, by block and by name: the whole isn't the sum."""
    one = admitted(spark, d)
    both = one.select("kind", "tag", "full", "block", "name").unionByName(one.select(F.lit("combined").alias("kind"), "tag", "full", "block", "name"))
    return both.groupBy("kind", "tag").agg(*(F.countDistinct(c).alias(f"by_{c}") for c in ("full", "block", "name")))


def with_without(spark: SparkSession, d: str) -> DataFrame:
    return admitted(spark, d).groupBy("tag").agg(F.countDistinct("name").alias("with_licensed"), F.countDistinct(F.when(F.col("kind") != "licensed", F.col("name"))).alias("without_licensed"))


def decision_counts(spark: SparkSession, d: str) -> DataFrame:
    return assertions(spark, d).groupBy(F.coalesce("decision", F.lit("undecided")).alias("decision")).agg(F.count("*").alias("n"))


def source_types(spark: SparkSession, d: str) -> DataFrame:
    return admitted(spark, d).groupBy("kind").agg(F.count("*").alias("rows"), F.countDistinct("name").alias("entities"), F.countDistinct("tag").alias("tags"))


def trusted_identity(spark: SparkSession, d: str) -> DataFrame:
    """Names merge into an identity only where its class is trusted; others are counted by name."""
    trust = F.when(F.length("name") % 2 == 1, "verbatim").otherwise("provisional")
    identity = F.when(trust == "verbatim", F.concat(F.lit("k"), F.substring("name", -1, 1))).otherwise(F.concat(F.lit("name:"), F.col("name")))
    return distinct_entities(admitted(spark, d).withColumn("identity", identity), "tag", "identity")


def bar_delta(spark: SparkSession, d: str) -> DataFrame:
    """Tags that reach the bar under one definition but not under the other."""
    sizes = admitted(spark, d).groupBy("tag").agg(F.countDistinct("name").alias("by_name"), F.countDistinct("full").alias("by_full"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("tag")))), ";")
    name, full = F.col("by_name") >= 45, F.col("by_full") >= 45
    return sizes.agg(listed(full & ~name).alias("gained"), listed(name & ~full).alias("lost"))


def entity_summary(spark: SparkSession, d: str) -> DataFrame:
    out = admitted(spark, d).groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("tag")), ";").alias("tags"), F.array_join(F.array_sort(F.collect_set("kind")), ";").alias("kinds"), F.countDistinct("doc_id").alias("docs"), F.count("*").alias("rows"))
    return out


def rarest_tag(spark: SparkSession, d: str) -> DataFrame:
    one = admitted(spark, d).select("name", "tag").distinct()
    support = one.groupBy("tag").agg(F.count("*").alias("support"))
    return one.join(F.broadcast(support), "tag").groupBy("name").agg(F.min_by("tag", F.struct("support", "tag")).alias("primary_tag"), F.count("*").alias("n_tags"))


def tag_pivot(spark: SparkSession, d: str) -> DataFrame:
    tags = ["article", "being", "link", "relation"]
    out = admitted(spark, d).select("name", "tag").distinct().groupBy("name").pivot("tag", tags).count().na.fill(0)
    return out.select("name", *(F.col(t).alias(f"tag_{t}") for t in tags))


def tag_pairs(spark: SparkSession, d: str) -> DataFrame:
    one = admitted(spark, d).select("tag", "doc_id").distinct()
    n = one.groupBy("tag").agg(F.count("*").alias("n"))
    pairs = one.alias("a").join(one.alias("b"), "doc_id").where(F.col("a.tag") < F.col("b.tag")).groupBy(F.col("a.tag").alias("tag_a"), F.col("b.tag").alias("tag_b")).agg(F.count("*").alias("both"))
    joined = pairs.join(n.select(F.col("tag").alias("tag_a"), F.col("n").alias("na")), "tag_a").join(n.select(F.col("tag").alias("tag_b"), F.col("n").alias("nb")), "tag_b")
    return joined.select("tag_a", "tag_b", F.round(F.col("both") / (F.col("na") + F.col("nb") - F.col("both")), 6).alias("jaccard"))


def top2_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges to a tag's two nearest tags (above 0.02), and all of 0.3 or more."""
    from pyspark.sql import Window

    pairs = tag_pairs(spark, d)
    both = pairs.unionByName(pairs.select(F.col("tag_b").alias("tag_a"), F.col("tag_a").alias("tag_b"), "jaccard"))
    order = Window.partitionBy("tag_a").orderBy(F.desc("jaccard"), "tag_b")
    near = both.withColumn("r", F.row_number().over(order)).where((F.col("r") <= 2) & (F.col("jaccard") > 0.02))
    return near.select("tag_a", "tag_b", "jaccard").unionByName(both.where(F.col("jaccard") >= 0.3)).select(F.least("tag_a", "tag_b").alias("tag_a"), F.greatest("tag_a", "tag_b").alias("tag_b"), "jaccard").distinct()


def family_vote(spark: SparkSession, d: str) -> DataFrame:
    family = F.when(F.col("tag").isin("article", "being"), "grammar").otherwise("structure")
    votes = admitted(spark, d).withColumn("family", family).groupBy("name", "family").agg(F.round(F.sum(F.when(F.col("tag") == "link", 0.6).otherwise(1.0)), 6).alias("votes"))
    return votes.groupBy("name").agg(F.max_by("family", F.struct("votes", "family")).alias("family"), F.max("votes").alias("votes"))


_A = rf"""WITH t AS (SELECT DISTINCT doc_id, CASE lang WHEN 'en' THEN 'review' WHEN 'fr' THEN 'database' WHEN 'de' THEN 'passage' ELSE 'licensed' END AS kind, source, lang, tag
  FROM (SELECT doc_id, lang, source, unnest(list_distinct(regexp_extract_all(lower(text), '\p{{L}}+'))) AS w FROM documents) JOIN {VOCABULARY_SQL} ON w = form),
a AS (SELECT t.doc_id, kind, CASE quality WHEN 1 THEN 'approve' WHEN 0 THEN 'reject' END AS decision, tag, 'm' || (doc_id % 61)::VARCHAR AS name, 'm' || (doc_id % 61)::VARCHAR || lang AS block, 'm' || (doc_id % 61)::VARCHAR || lang || source AS "full" FROM t LEFT JOIN labels USING (doc_id)),
m AS (SELECT * FROM a WHERE CASE WHEN kind = 'review' THEN decision IS NOT DISTINCT FROM 'approve' ELSE decision IS DISTINCT FROM 'reject' END),
e AS (SELECT tag, count(DISTINCT name) AS entities FROM m GROUP BY tag),
el AS (SELECT tag, count(DISTINCT name) AS entities FROM m WHERE kind = 'licensed' GROUP BY tag)"""
_J = ", o AS (SELECT DISTINCT tag, doc_id FROM m), n AS (SELECT tag, count(*) AS n FROM o GROUP BY tag), p AS (SELECT a.tag AS tag_a, b.tag AS tag_b, round(count(*)::DOUBLE / (any_value(na.n) + any_value(nb.n) - count(*)), 6) AS jaccard FROM o a JOIN o b USING (doc_id) JOIN n na ON na.tag = a.tag JOIN n nb ON nb.tag = b.tag WHERE a.tag < b.tag GROUP BY a.tag, b.tag)"
PLANS: Plans = {
    "tag_distinct_entities": (per_tag, f"{_A} SELECT * FROM e"),
    "at_bar": (at_bar, f"{_A} SELECT * FROM e WHERE entities >= {BAR}"),
    "near_bar": (near_bar, f"{_A} SELECT * FROM el WHERE entities BETWEEN {NEAR} AND {BAR - 1}"),
    "shortfall_forms": (lambda s, d: shortfall(s, d, "forms"), f"{_A} SELECT sum(greatest(0, {BAR} - coalesce(entities, 0)))::BIGINT AS shortfall_forms FROM {VOCABULARY_SQL} LEFT JOIN el USING (tag)"),
    "shortfall_tags": (lambda s, d: shortfall(s, d, "tags"), f"{_A} SELECT sum(greatest(0, {BAR} - coalesce(entities, 0)))::BIGINT AS shortfall_tags FROM (SELECT DISTINCT tag FROM {VOCABULARY_SQL}) LEFT JOIN el USING (tag)"),
    "three_granularity": (three_granularity, f'{_A}, b AS (SELECT kind, tag, "full", block, name FROM m UNION ALL SELECT \'combined\', tag, "full", block, name FROM m) SELECT kind, tag, count(DISTINCT "full") AS by_full, count(DISTINCT block) AS by_block, count(DISTINCT name) AS by_name FROM b GROUP BY kind, tag'),
    "with_without_source": (with_without, f"{_A} SELECT tag, count(DISTINCT name) AS with_licensed, count(DISTINCT name) FILTER (kind <> 'licensed') AS without_licensed FROM m GROUP BY tag"),
    "decision_counts": (decision_counts, f"{_A} SELECT coalesce(decision, 'undecided') AS decision, count(*) AS n FROM a GROUP BY 1"),
    "source_type_counts": (source_types, f'{_A} SELECT kind, count(*) AS "rows", count(DISTINCT name) AS entities, count(DISTINCT tag) AS tags FROM m GROUP BY kind'),
    "trusted_identity": (trusted_identity, f"{_A} SELECT tag, count(DISTINCT CASE WHEN length(name) % 2 = 1 THEN 'k' || right(name, 1) ELSE 'name:' || name END) AS entities FROM m GROUP BY tag"),
    "bar_delta": (bar_delta, f'{_A}, f AS (SELECT tag FROM m GROUP BY tag HAVING count(DISTINCT "full") >= 45), n AS (SELECT tag FROM m GROUP BY tag HAVING count(DISTINCT name) >= 45) SELECT coalesce((SELECT string_agg(tag, \';\' ORDER BY tag) FROM f WHERE tag NOT IN (SELECT tag FROM n)), \'\') AS gained, coalesce((SELECT string_agg(tag, \';\' ORDER BY tag) FROM n WHERE tag NOT IN (SELECT tag FROM f)), \'\') AS lost'),
    "entity_summary": (entity_summary, f"{_A} SELECT name, string_agg(DISTINCT tag, ';' ORDER BY tag) AS tags, string_agg(DISTINCT kind, ';' ORDER BY kind) AS kinds, count(DISTINCT doc_id) AS docs, count(*) AS \"rows\" FROM m GROUP BY name"),
    "rarest_tag": (rarest_tag, f"{_A}, o AS (SELECT DISTINCT name, tag FROM m), s AS (SELECT tag, count(*) AS support FROM o GROUP BY tag) SELECT name, arg_min(tag, (support, tag)) AS primary_tag, count(*) AS n_tags FROM o JOIN s USING (tag) GROUP BY name"),
    "tag_pivot": (tag_pivot, f"{_A}, o AS (SELECT DISTINCT name, tag FROM m) SELECT name, {', '.join(f"count(*) FILTER (tag = '{t}') AS tag_{t}" for t in ('article', 'being', 'link', 'relation'))} FROM o GROUP BY name"),
    "tag_jaccard": (tag_pairs, f"{_A}{_J} SELECT * FROM p"),
    "top2_edges": (top2_edges, f"{_A}{_J}, b AS (SELECT * FROM p UNION ALL SELECT tag_b, tag_a, jaccard FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY tag_a ORDER BY jaccard DESC, tag_b) AS r FROM b) SELECT DISTINCT least(tag_a, tag_b) AS tag_a, greatest(tag_a, tag_b) AS tag_b, jaccard FROM r WHERE (r <= 2 AND jaccard > 0.02) OR jaccard >= 0.3"),
    "family_vote": (family_vote, f"{_A}, v AS (SELECT name, CASE WHEN tag IN ('article', 'being') THEN 'grammar' ELSE 'structure' END AS family, round(sum(CASE WHEN tag = 'link' THEN 0.6::DOUBLE ELSE 1.0::DOUBLE END), 6) AS votes FROM m GROUP BY 1, 2) SELECT name, arg_max(family, (votes, family)) AS family, max(votes) AS votes FROM v GROUP BY name"),
}
