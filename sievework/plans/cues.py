"""Rules and cues on sentences written for the purpose, one at least for each rule; guards, and edits of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import predicates as P
from ..operators.rules import AFTER, BEFORE
from ..session import table
from ..sources.sinks import edited_lines
from .base import SENTENCES_SQL, VOCABULARY, VOCABULARY_SQL, Plans, sentences, vocabulary

#: One sentence or more for every rule of the cascade, and some that are kept.
SMELLS = (
    "Geraniol smells of roses.",
    "Geraniol has a sweet odor " + "and a warm rosy note " * 15,
    "The odor value of geraniol has been found to be very high",
    "In the odour test geraniol has a rosy note of some strength",
    "A malodor of the butanal has a sour note that must be covered",
    "To a person skilled in perfumery geraniol has a rosy odor",
    "In this embodiment geraniol has a rosy odor of great charm",
    "A mixture with 12.5 wt. % of geraniol has a rosy odor",
    "The base comprises an alcohol with geraniol and has a rosy odor",
    "After reflux the geraniol has a rosy odor and a pale colour",
    "A note selected from the group consisting of geraniol has charm",
    "A lactone preferably having a milky note has a wide use",
    "Geraniol may impart a rosy odor and has a wide use in soap",
    "Geraniol has odor properties that are those of a rose",
    "A rosy odor that geraniol has by combining with citral",
    "Geraniol has no odor that one could call unpleasant",
    "Geraniol has a charm devoid of any sour odor whatever",
    "Geraniol has a more rosy odor than the others of its kind",
    "Geraniol has an odor intensity which is that of a rose",
    "Geraniol has an olfactory performance beside its rosy odor",
    "Geraniol has a way of changing the odor of a finished soap",
    "The rosy odor that geraniol has is described in an old book",
    "Please note that geraniol has a rosy odor of great charm",
    "Geraniol has a very pleasant and rosy charm in all soaps",
    "Geraniol and the rosy odor of a garden in the early summer",
    "This fine liquid has a rosy odor of great charm and warmth",
    "Geraniol has a rosy odor of great charm and some warmth",
    "3-(4-isopropylphenyl)butanal exhibits a green, floral note",
    "Olfactive description of citronellal: green, fresh, lemon",
    "Rosalva Plus\u2122 has a waxy and rosy odor of great charm",
)
def _rows(spark: SparkSession, fields: str, rows: tuple) -> DataFrame:
    return spark.createDataFrame([(n, *(x if isinstance(x, tuple) else (x,))) for n, x in enumerate(rows)], f"id int, {fields}")


def cue_flags(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of the documents and those above that deny, or that no row can come of."""
    own = _rows(spark, "s string", SMELLS).select(F.lit("own").alias("lang"), "s")
    every = sentences(spark, d).select("lang", "s").unionByName(own)
    return every.groupBy("lang").agg(F.count_if(P.negated("s")).alias("negated"), F.count_if(P.dead("s")).alias("dead"))


def guarded(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents as decisions: the first and the last word as spans, of each third one a word that isn't there."""
    w = F.split("text", " ")
    spans = F.array(F.get(w, F.lit(0)), F.when(F.col("doc_id") % 3 == 0, F.lit("zzyx")).otherwise(F.element_at(w, -1)))
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", "text", spans.alias("spans"), F.when(F.col("quality") == 1, "approve").otherwise("reject").alias("decision"))
    return P.save_guard(rows, "text", "spans", "decision").select("doc_id", F.size("spans").alias("spans"), "saved")


def _passages(spark: SparkSession, d: str) -> DataFrame:
    """s, docs: sentences of forty characters or more in three documents or more."""
    return sentences(spark, d).where(F.length("s") >= 40).groupBy("s").agg(F.countDistinct("doc_id").alias("docs")).where(F.col("docs") >= 3)


def _carried() -> Column:
    """The forms of the vocabulary that stand in s as words of their own, in order."""
    forms = F.array(*(F.lit(f) for f in sorted(VOCABULARY)))
    return F.filter(forms, lambda f: F.rlike("s", F.concat(F.lit(f"(?i){BEFORE}"), f, F.lit(AFTER))))


def passage_terms(spark: SparkSession, d: str) -> DataFrame:
    """Repeated passages with the vocabulary they carry; those that carry none are left out."""
    terms = _carried()
    return _passages(spark, d).select(F.md5("s").alias("digest"), "docs", F.size(terms).alias("n_terms"), F.array_join(terms, ",").alias("terms")).where(F.col("n_terms") > 0)


def term_max_passage(spark: SparkSession, d: str) -> DataFrame:
    """For each term of the vocabulary the documents of the largest repeated passage that carries it; 0 if none does."""
    found = _passages(spark, d).select("docs", F.explode(_carried()).alias("form"))
    most = found.groupBy("form").agg(F.max("docs").alias("max_docs"))
    return vocabulary(spark).join(most, "form", "left").select("form", F.coalesce("max_docs", F.lit(0).cast("long")).alias("max_docs"))


def rewritten_lines(spark: SparkSession, d: str) -> DataFrame:
    """Regions as JSON lines with a note in front and a blank line, one of them edited."""
    regions = table(spark, d, "region").select(F.col("r_regionkey").cast("int").alias("n"), F.concat(F.lit('{"id": "'), F.col("r_regionkey").cast("string"), F.lit('", "name": "'), F.col("r_name"), F.lit('"}')).alias("line"))
    more = spark.createDataFrame([(-1, '{"_comment": "kept as it is",  "x":1}'), (99, "")], "n int, line string")
    edits = spark.createDataFrame([("2", '{"name": "\u00c9DIT", "note": "was other"}')], "id string, changes string")
    return edited_lines(regions.unionByName(more), edits, ["id"])


def _sql_values(rows: list[tuple]) -> str:
    quoted = lambda x: str(x) if isinstance(x, int | bool) else "'" + x.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows) + ")"


_SMELLS_SQL = f"{_sql_values(list(enumerate(SMELLS)))} v(id, s)"
_PASSAGES_SQL = f"{SENTENCES_SQL}, p AS (SELECT s, count(DISTINCT doc_id) AS docs FROM s WHERE length(s) >= 40 GROUP BY s HAVING count(DISTINCT doc_id) >= 3)"
_TERMS_SQL = f"{_PASSAGES_SQL}, t AS (SELECT s, docs, form FROM p, {VOCABULARY_SQL} WHERE regexp_matches(s, '(?i){BEFORE}' || form || '{AFTER}'))"
# Borders of words count accents here, which SQL must be told.
_NEGATED, _DEAD = P.NEGATION.replace(r"\b(", f"{BEFORE}(").replace(r")\b", f"){AFTER}"), P.DEAD
PLANS: Plans = {
    "cue_flags": (cue_flags, f"WITH {SENTENCES_SQL}, e AS (SELECT lang, s FROM s UNION ALL SELECT 'own', s FROM {_SMELLS_SQL}) SELECT lang, count(*) FILTER (regexp_matches(s, '{_NEGATED}')) AS negated, count(*) FILTER (regexp_matches(s, '{_DEAD}')) AS dead FROM e GROUP BY lang"),
    "save_guard": (guarded, "WITH r AS (SELECT doc_id, text, string_split(text, ' ') AS w, quality = 1 AS kept FROM documents JOIN labels USING (doc_id)) SELECT doc_id, (CASE WHEN kept THEN 2 ELSE 0 END)::INTEGER AS spans, coalesce(NOT kept, true) OR coalesce(contains(text, w[1]) AND contains(text, CASE WHEN doc_id % 3 = 0 THEN 'zzyx' ELSE w[-1] END), false) AS saved FROM r"),
    "passage_terms": (passage_terms, f"WITH {_TERMS_SQL} SELECT md5(s) AS digest, docs, count(*)::INTEGER AS n_terms, string_agg(form, ',' ORDER BY form) AS terms FROM t GROUP BY s, docs"),
    "term_max_passage": (term_max_passage, f"WITH {_TERMS_SQL} SELECT v.form, coalesce(max(docs), 0)::BIGINT AS max_docs FROM {VOCABULARY_SQL} LEFT JOIN t USING (form) GROUP BY v.form"),
    "rewritten_lines": (
        rewritten_lines,
        """SELECT r_regionkey::INTEGER AS n, CASE WHEN r_regionkey = 2 THEN '{"id": "2", "name": "\u00c9DIT", "note": "was other"}' ELSE '{"id": "' || r_regionkey || '", "name": "' || r_name || '"}' END AS line FROM region
        UNION ALL SELECT -1, '{"_comment": "kept as it is",  "x":1}' UNION ALL SELECT 99, ''""",
    ),
}
