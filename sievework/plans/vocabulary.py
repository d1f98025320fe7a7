"""Terms: how often, in how many documents, how independently, and what the vocabulary makes of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import counts as C
from ..session import table
from .base import SENTENCES_SQL, TOKENS_SQL, VOCABULARY_SQL, Plans, sentences, tokens, vocabulary

HEADS = ("tion", "thing", "ment")
STOP = ("the", "and", "that", "for", "les", "que", "der", "die", "und", "las", "los")


def sentence_words(spark: SparkSession, d: str) -> DataFrame:
    """w, doc_id, k, s for each word and sentence it stands in; k is the sentence's digest, s goes unless it is asked for."""
    split = sentences(spark, d).select("doc_id", "s", F.unhex(F.md5("s")).alias("k"), F.array_distinct(T.words("s")).alias("words"))
    return split.select("doc_id", "s", "k", F.explode("words").alias("w"))


def document_words(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, words: all of a document's, in order."""
    return table(spark, d, "documents").select("doc_id", T.words("text").alias("words"))


def of_sentences(spark: SparkSession, d: str) -> tuple[DataFrame, str, DataFrame, str, Callable[[Column], Column], str, str]:
    """What counts of whole vocabularies ask for: documents with the words of their sentences, and the sentences."""
    docs = table(spark, d, "documents").select("doc_id", F.array_distinct(T.words(T.norm_text("text"))).alias("words"))
    return docs, "words", sentences(spark, d), "s", T.words, "w", "doc_id"


def term_doc_freq(spark: SparkSession, d: str) -> DataFrame:
    return C.word_frequencies(document_words(spark, d), "words", "w", "doc_id")


def content_terms(spark: SparkSession, d: str) -> DataFrame:
    out = C.word_frequencies(document_words(spark, d), "words", "w", "doc_id")
    return out.where((F.col("docs") >= 20) & (F.length("w") > 2) & ~F.col("w").isin(*STOP))


def pre_head_terms(spark: SparkSession, d: str) -> DataFrame:
    """The word before a head noun."""
    found = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(rf"([a-z]+)[ ,]+(?:{'|'.join(HEADS)}) "), 1)).alias("w"))
    return C.frequencies(found.where(F.length("w") > 2), "w", "doc_id")


def attestations(spark: SparkSession, d: str) -> DataFrame:
    return C.attestations(sentence_words(spark, d).where(F.col("w").isin("tion", "idiot", "thing", "avec", "nicht", "ciónción")), "w", "k", "doc_id", "s")


def copy_factor(spark: SparkSession, d: str) -> DataFrame:
    """Suspect terms of a stand-in for a term list: the words of more than 14 letters. suspect_terms has those of all words."""
    out = C.attestations(sentence_words(spark, d).where(F.length("w") > 14), "w", "k", "doc_id", "s").where(F.col("docs") >= 3)
    return out.where((F.col("copy_factor") >= 3) | (F.col("top_share") >= 0.5)).select("w", "docs", "copy_factor", F.md5("top_sentence").alias("top_sentence"))


def suspect_terms(spark: SparkSession, d: str) -> DataFrame:
    """Suspect terms among all words."""
    return C.suspects(*of_sentences(spark, d)).select("w", "docs", "copy_factor", F.md5("top_sentence").alias("top_sentence"))


def boilerplate_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Share of a term's documents that have its most common surroundings; a term that isn't there has zeros."""
    terms = spark.range(1).select(F.explode(F.array(*map(F.lit, ("token", "license", "copyright", "zzyx")))).alias("w"))
    hits = "token|license|copyright"
    low = table(spark, d, "documents").select("doc_id", F.lower("text").alias("t")).where(F.rlike("t", F.lit(hits)))
    cut = low.select("doc_id", F.split("t", hits).alias("p"), F.regexp_extract_all("t", F.lit(f"({hits})"), 1).alias("h"))
    around = F.transform("h", lambda w, i: F.struct(w.alias("w"), F.concat(F.right(F.get("p", i), F.lit(30)), w, F.left(F.get("p", i + 1), F.lit(30))).alias("context")))
    found = cut.select("doc_id", F.explode(around).alias("x")).select("doc_id", "x.w", "x.context")
    per = found.groupBy("w", "context").agg(F.countDistinct("doc_id").alias("n"))
    modal = per.groupBy("w").agg(F.max("n").alias("modal"))
    docs = found.groupBy("w").agg(F.countDistinct("doc_id").alias("docs"))
    out = terms.join(docs, "w", "left").join(modal, "w", "left").na.fill(0, ["docs", "modal"])
    return out.select("w", "docs", "modal", F.round(F.coalesce(F.try_divide(F.col("modal").cast("double"), F.col("docs").cast("double")), F.lit(0.0)), 6).alias("ratio"))


def repeated_passages(spark: SparkSession, d: str) -> DataFrame:
    pieces = table(spark, d, "documents").select("doc_id", F.explode(T.loose_sentences("text")).alias("s")).select("doc_id", F.lower(T.collapse("s")).alias("s"))
    return C.repeated(pieces.where((F.length("s") > 40) & (F.length("s") < 600)), "s", "doc_id", 5).select(F.md5("s").alias("passage"), "docs")


def two_threshold_admission(spark: SparkSession, d: str) -> DataFrame:
    out = C.attested(*of_sentences(spark, d))
    return out.where((F.col("docs") >= 20) & (F.col("attestations") >= 30)).select("w", "docs", "attestations")


def forms_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """A vocabulary as merged from many hands: form (a part's name and brand, as some write it), tag (its kind), layer (its size)."""
    form = F.concat_ws(" ", "p_name", "p_brand")
    return table(spark, d, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.upper(form)).otherwise(form).alias("form"), F.col("p_type").alias("tag"), F.col("p_size").alias("layer"))


def vocab_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Forms that a merged vocabulary maps to more than one tag; a loader must fail on them."""
    return forms_of_parts(spark, d).groupBy(F.lower("form").alias("form")).agg(F.countDistinct("tag").alias("tags"), F.array_join(F.array_sort(F.collect_set("tag")), ";").alias("which")).where(F.col("tags") > 1)


def overlay_classes(spark: SparkSession, d: str) -> DataFrame:
    """Later layers win (of one layer the greatest class), and forms in use, those of parts sold at the greatest discount, are of class D whatever the layers say."""
    own = forms_of_parts(spark, d).select(F.lower("form").alias("form"), F.col("tag").alias("class"), "layer")
    sold = table(spark, d, "lineitem").where(F.col("l_discount") >= 0.1).select(F.col("l_partkey").alias("p_partkey")).distinct()
    used = table(spark, d, "part").join(sold, "p_partkey").select(F.lower(F.concat_ws(" ", "p_name", "p_brand")).alias("form"), F.lit("D").alias("class"), F.lit(1 << 30).alias("layer"))
    return own.unionByName(used).groupBy("form").agg(F.max(F.struct("layer", "class")).alias("m")).select("form", F.col("m.class").alias("class"))


def unmapped_terms(spark: SparkSession, d: str) -> DataFrame:
    used = tokens(spark, d).join(F.broadcast(vocabulary(spark)), F.col("w") == F.col("form"), "left").where(F.col("tag").isNull())
    return used.groupBy("w").agg(F.count("*").alias("uses"), F.countDistinct("source").alias("sources"), F.countDistinct("doc_id").alias("docs")).where(F.col("docs") >= 50)


def never_attested(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary(spark).where(~F.contains("form", F.lit(" "))).join(tokens(spark, d).select("w").distinct(), F.col("form") == F.col("w"), "left_anti")


def first_mention(spark: SparkSession, d: str) -> DataFrame:
    """For each document and tag the first word of the vocabulary."""
    words = table(spark, d, "documents").select("doc_id", F.posexplode(T.words("text")).alias("pos", "w"))
    joined = words.join(F.broadcast(vocabulary(spark)), F.col("w") == F.col("form"))
    return joined.groupBy("doc_id", "tag").agg(F.min_by("form", "pos").alias("form"), F.min("pos").alias("pos"))


def edit_distance_one(spark: SparkSession, d: str) -> DataFrame:
    """Frequent words one edit away from a form of the vocabulary that aren't in it."""
    frequent = C.word_frequencies(document_words(spark, d), "words", "w", "doc_id").where((F.col("docs") >= 30) & F.rlike("w", F.lit("^[a-z]{4,}$")))
    # Words one edit apart become equal when at most one letter of each is left out.
    keys = lambda w: F.explode(F.array_distinct(F.concat(F.array(w), F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))))))
    left = frequent.select("w", "docs", keys(F.col("w")).alias("k"))
    right = vocabulary(spark).where(F.length("form") >= 4).select("form", keys(F.col("form")).alias("k"))
    return left.join(right, "k").where(F.levenshtein("w", "form") == 1).select("w", "form", "docs").distinct()


def topk_terms(spark: SparkSession, d: str) -> DataFrame:
    return C.word_frequencies(document_words(spark, d), "words", "w", "doc_id").orderBy(F.desc("n"), "w").limit(25)


def cap_per_source(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("source").orderBy("doc_id")
    return table(spark, d, "documents").select("source", "doc_id", F.row_number().over(order).alias("n")).where(F.col("n") <= 3)


_FREQ = f"WITH {TOKENS_SQL}, f AS (SELECT w, count(*) AS n, count(DISTINCT doc_id) AS docs FROM tok GROUP BY w)"
_WORDS = rf"WITH {SENTENCES_SQL}, sw AS (SELECT DISTINCT doc_id, s, unnest(list_distinct(regexp_extract_all(lower(s), '\p{{L}}+'))) AS w FROM s)"
_ATTEST = ", k AS (SELECT w, s, count(DISTINCT doc_id) AS d FROM sw GROUP BY w, s), dd AS (SELECT w, count(DISTINCT doc_id) AS docs FROM sw GROUP BY w), a AS (SELECT k.w, any_value(docs) AS docs, count(*) AS attestations, round(any_value(docs)::DOUBLE / count(*), 6) AS copy_factor, round(max(d)::DOUBLE / any_value(docs), 6) AS top_share, min(s) FILTER (d = m) AS top_sentence FROM (SELECT *, max(d) OVER (PARTITION BY w) AS m FROM k) k JOIN dd USING (w) GROUP BY k.w)"
PLANS: Plans = {
    "term_doc_freq": (term_doc_freq, f"{_FREQ} SELECT * FROM f"),
    "content_terms": (content_terms, f"{_FREQ} SELECT * FROM f WHERE length(w) > 2 AND docs >= 20 AND w NOT IN ({', '.join(repr(x) for x in STOP)})"),
    "pre_head_terms": (pre_head_terms, f"WITH p AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '([a-z]+)[ ,]+(?:{'|'.join(HEADS)}) ', 1)) AS w FROM documents) SELECT w, count(*) AS n, count(DISTINCT doc_id) AS docs FROM p WHERE length(w) > 2 GROUP BY w"),
    "attestations": (attestations, f"{_WORDS}{_ATTEST} SELECT * FROM a WHERE w IN ('tion', 'idiot', 'thing', 'avec', 'nicht', 'ciónción')"),
    "copy_factor_top_sentence": (copy_factor, f"{_WORDS}{_ATTEST} SELECT w, docs, copy_factor, md5(top_sentence) AS top_sentence FROM a WHERE length(w) > 14 AND docs >= 3 AND (copy_factor >= 3 OR top_share >= 0.5)"),
    "suspect_terms": (suspect_terms, f"{_WORDS}{_ATTEST} SELECT w, docs, copy_factor, md5(top_sentence) AS top_sentence FROM a WHERE docs >= 3 AND (copy_factor >= 3 OR top_share >= 0.5)"),
    "boilerplate_ratio": (boilerplate_ratio, "WITH t AS (SELECT unnest(['token', 'license', 'copyright', 'zzyx']) AS w), c AS (SELECT doc_id, string_split_regex(lower(text), 'token|license|copyright') AS p, regexp_extract_all(lower(text), 'token|license|copyright') AS h FROM documents), f AS (SELECT doc_id, unnest(h) AS w, unnest(list_transform(range(1, len(h) + 1), lambda i: right(p[i], 30) || h[i] || left(p[i + 1], 30))) AS context FROM c), p AS (SELECT w, context, count(DISTINCT doc_id) AS n FROM f GROUP BY w, context), m AS (SELECT w, max(n) AS modal FROM p GROUP BY w), dd AS (SELECT w, count(DISTINCT doc_id) AS docs FROM f GROUP BY w) SELECT w, coalesce(docs, 0) AS docs, coalesce(modal, 0) AS modal, round(coalesce(modal::DOUBLE / docs, 0), 6) AS ratio FROM t LEFT JOIN dd USING (w) LEFT JOIN m USING (w)"),
    "repeated_passages": (repeated_passages, r"WITH p AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.;])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM documents), q AS (SELECT doc_id, lower(trim(regexp_replace(s, '\s+', ' ', 'g'))) AS s FROM p) SELECT md5(s) AS passage, count(DISTINCT doc_id) AS docs FROM q WHERE length(s) > 40 AND length(s) < 600 GROUP BY s HAVING count(DISTINCT doc_id) >= 5"),
    "two_threshold_admission": (two_threshold_admission, f"{_WORDS}{_ATTEST} SELECT w, docs, attestations FROM a WHERE docs >= 20 AND attestations >= 30"),
    "vocab_conflicts": (vocab_conflicts, "SELECT lower(p_name || ' ' || p_brand) AS form, count(DISTINCT p_type) AS tags, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS which FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1"),
    "overlay_classes": (overlay_classes, "WITH l AS (SELECT lower(p_name || ' ' || p_brand) AS form, p_type AS class, p_size AS layer FROM part UNION ALL SELECT lower(p_name || ' ' || p_brand), 'D', 1073741824 FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1)), r AS (SELECT form, class, row_number() OVER (PARTITION BY form ORDER BY layer DESC, class DESC) AS n FROM l) SELECT form, class FROM r WHERE n = 1"),
    "unmapped_terms": (unmapped_terms, f"WITH {TOKENS_SQL} SELECT w, count(*) AS uses, count(DISTINCT source) AS sources, count(DISTINCT doc_id) AS docs FROM tok WHERE w NOT IN (SELECT form FROM {VOCABULARY_SQL}) GROUP BY w HAVING count(DISTINCT doc_id) >= 50"),
    "never_attested": (never_attested, f"WITH {TOKENS_SQL} SELECT form, tag FROM {VOCABULARY_SQL} WHERE NOT contains(form, ' ') AND form NOT IN (SELECT w FROM tok)"),
    "first_mention": (first_mention, rf"WITH t AS (SELECT doc_id, unnest(l) AS w, unnest(range(len(l)))::INTEGER AS pos FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+') AS l FROM documents)) SELECT doc_id, tag, min_by(form, pos) AS form, min(pos) AS pos FROM t JOIN {VOCABULARY_SQL} ON w = form GROUP BY doc_id, tag"),
    "edit_distance_one": (edit_distance_one, f"{_FREQ} SELECT w, form, docs FROM f JOIN {VOCABULARY_SQL} ON length(form) >= 4 AND levenshtein(w, form) = 1 WHERE docs >= 30 AND regexp_matches(w, '^[a-z]{{4,}}$')"),
    "topk_terms": (topk_terms, f"{_FREQ} SELECT * FROM f ORDER BY n DESC, w LIMIT 25"),
    "cap_per_source": (cap_per_source, "SELECT source, doc_id, n::INTEGER AS n FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 3"),
}
