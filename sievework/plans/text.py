"""Normalising, splitting and judging sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.rules import DATA_RULES, KEPT, first_reason, funnel, is_named, single_gate_rows
from ..session import table
from .base import SENTENCES_SQL, Plans, sentences, sql_gates_failed, sql_named, sql_norm, sql_reason


def norm_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.norm_text("text").alias("t")).select("doc_id", F.length("t").cast("long").alias("chars"), F.md5("t").alias("digest"))


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).groupBy("doc_id").agg(F.count("*").alias("sentences"), F.countDistinct("s").alias("distinct_sentences"), F.sum(F.length("s").cast("long")).alias("chars"))


def judged(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).withColumn("reason", first_reason("s", DATA_RULES))


def sentence_funnel(spark: SparkSession, d: str) -> DataFrame:
    return funnel(judged(spark, d), DATA_RULES)


def accept_reason_histogram(spark: SparkSession, d: str) -> DataFrame:
    return judged(spark, d).groupBy("reason").agg(F.count("*").alias("n"), F.count_if(is_named("s", DATA_RULES)).alias("named"))


def accepted_sentences(spark: SparkSession, d: str) -> DataFrame:
    return judged(spark, d).where(F.col("reason") == KEPT).select("doc_id", "pos", "s")


def verbatim_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Accepted sentences with the place of their first occurrence in the normalised text."""
    docs = table(spark, d, "documents").select("doc_id", T.norm_text("text").alias("t"))
    split = docs.select("doc_id", "t", F.explode(T.sentences("t")).alias("s")).withColumn("reason", first_reason("s", DATA_RULES)).where(F.col("reason") == KEPT)
    return split.select("doc_id", F.md5("s").alias("digest"), T.offset("t", "s").cast("long").alias("char_offset"), T.verbatim("t", "s").alias("verbatim"))


def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "pages").select("page_id", T.html_to_text("html").alias("t"))
    return out.where(F.length("t") >= 100).select("page_id", F.length("t").cast("long").alias("chars"), F.md5("t").alias("digest"))


def entity_decode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.has_entity("html").alias("has_entity"), F.md5(T.decode_entities("html")).alias("digest"))


def clause_gate(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of which one clause has both a word of being and a name."""
    split = sentences(spark, d).withColumn("clauses", F.split("s", r"[,;:]\s+"))
    ok = F.exists("clauses", lambda c: F.rlike(c, F.lit(DATA_RULES.attribution[0])) & F.rlike(c, F.lit(DATA_RULES.suffix_token)))
    return split.groupBy("lang").agg(F.sum(F.size("clauses").cast("long")).alias("clauses"), F.count_if(ok).alias("passed"))


def context_window(spark: SparkSession, d: str) -> DataFrame:
    """The surroundings of the first mention of a word in each document."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.locate("tion ", F.col("text")).alias("at")).where(F.col("at") > 0)
    return docs.select("doc_id", T.context("text", F.col("at"), F.lit(4)).alias("context"))


def dead_rows(spark: SparkSession, d: str) -> DataFrame:
    """How many sentences that fail one gate alone each candidate rule would catch."""
    return single_gate_rows(sentences(spark, d), {"digits": "[0-9]", "bars": r"\|", "bangs": "!!"}, DATA_RULES)


def quoted_json(spark: SparkSession, d: str) -> DataFrame:
    """Whether a value stands in JSON text as it is or escaped; nested values read with a schema."""
    events = table(spark, d, "events").where(F.col("event_id") < 2**62)
    parsed = events.withColumn("k", F.from_json("props", "k bigint")["k"])
    return parsed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"), F.count_if(F.contains("props", F.concat(F.lit('"k": '), F.col("k").cast("string")))).alias("verbatim"))


def page_titles(spark: SparkSession, d: str) -> DataFrame:
    """A named section of each page and its host."""
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.regexp_extract("url", r"^[a-z]+://([^/:]+)", 1).alias("host"))


_JUDGED = f"WITH {SENTENCES_SQL}, j AS (SELECT *, {sql_reason('s')} AS reason FROM s)"
_HTML = sql_norm(r"regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<pre\b[^>]*>.*?</pre>', ' ', 'g'), '<[^>]+>', ' ', 'g')")
_DECODED = "html"
for _a, _b in T.NAMED_ENTITIES.items():
    _DECODED = f"replace({_DECODED}, '{_a}', '{_b.replace(chr(39), chr(39) * 2)}')"
PLANS: Plans = {
    "sentence_funnel": (sentence_funnel, f"{_JUDGED} SELECT count(*) AS sentences, count(*) FILTER (length(s) > 25 AND length(s) < 320 AND regexp_matches(s, '{DATA_RULES.head}')) AS with_head, count(*) FILTER (reason NOT IN ('length', 'kept', 'no head word', 'no description verb', 'no name')) AS excluded, count(*) FILTER (reason = 'kept') AS kept FROM j"),
    "norm_text": (norm_text, f"SELECT doc_id, length(t)::BIGINT AS chars, md5(t) AS digest FROM (SELECT doc_id, {sql_norm('text')} AS t FROM documents)"),
    "sentence_split": (sentence_split, f"WITH {SENTENCES_SQL} SELECT doc_id, count(*) AS sentences, count(DISTINCT s) AS distinct_sentences, sum(length(s))::BIGINT AS chars FROM s GROUP BY doc_id"),
    "accept_reason_histogram": (accept_reason_histogram, f"{_JUDGED} SELECT reason, count(*) AS n, count(*) FILTER ({sql_named('s')}) AS named FROM j GROUP BY reason"),
    "accepted_sentences": (accepted_sentences, f"{_JUDGED} SELECT doc_id, pos, s FROM j WHERE reason = 'kept'"),
    "verbatim_offsets": (verbatim_offsets, f"{_JUDGED} SELECT j.doc_id, md5(s) AS digest, (strpos(t, s) - 1)::BIGINT AS char_offset, contains(t, s) AS verbatim FROM j JOIN n USING (doc_id) WHERE reason = 'kept'"),
    "html_to_text": (html_to_text, f"SELECT page_id, length(t)::BIGINT AS chars, md5(t) AS digest FROM (SELECT page_id, {_HTML} AS t FROM pages) WHERE length(t) >= 100"),
    "entity_decode": (entity_decode, f"SELECT page_id, regexp_matches(html, '&(#[0-9]+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);') AS has_entity, md5({_DECODED}) AS digest FROM pages"),
    "clause_gate": (clause_gate, rf"WITH {SENTENCES_SQL}, c AS (SELECT lang, string_split_regex(s, '[,;:]\s+') AS c FROM s) SELECT lang, sum(len(c))::BIGINT AS clauses, count(*) FILTER (len(list_filter(c, lambda x: regexp_matches(x, '{DATA_RULES.attribution[0]}') AND regexp_matches(x, '{DATA_RULES.suffix_token}'))) > 0) AS passed FROM c GROUP BY lang"),
    "context_window": (context_window, r"SELECT doc_id, lower(trim(regexp_replace(substr(text, greatest(1, p - 55), p + 59 - greatest(1, p - 55)), '\s+', ' ', 'g'))) AS context FROM (SELECT doc_id, text, strpos(text, 'tion ') AS p FROM documents) WHERE p > 0"),
    "rule_sizing": (dead_rows, rf"WITH {SENTENCES_SQL} SELECT count(*) FILTER (regexp_matches(s, '[0-9]')) AS digits, count(*) FILTER (regexp_matches(s, '\|')) AS bars, count(*) FILTER (regexp_matches(s, '!!')) AS bangs, count(*) FILTER (regexp_matches(s, '[0-9]|\||!!')) AS any_pattern FROM s WHERE {sql_gates_failed('s', DATA_RULES)} = 1"),
    "nested_json": (quoted_json, "SELECT event_type, count(*) AS n, sum(k)::BIGINT AS total, count(*) FILTER (contains(props, '\"k\": ' || k::VARCHAR)) AS verbatim FROM (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events) GROUP BY event_type"),
    "page_sections": (page_titles, "SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, regexp_extract(url, '^[a-z]+://([^/:]+)', 1) AS host FROM pages"),
}
