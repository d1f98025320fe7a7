"""Functions on fields, and files written and read back, as relations over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as N
from ..functions import text as T
from ..operators import predicates as P
from ..session import ensure_checkpoint_dir, table
from ..sources import readers, sinks
from .base import Plans

_STOP = ("the", "and", "die", "der", "les", "que", "para", "con")
_CLASSES = ("STEEL", "COPPER")


def _folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors share; it goes when the application ends."""
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    where = f"{context._jsc.sc().getCheckpointDir().get()}/files-{uuid.uuid4().hex}"
    path = context._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where


def text_fields(spark: SparkSession, d: str) -> DataFrame:
    """Keys, clean fields, word counts and the words that matter, of the names of parts."""
    name = F.concat(F.lit("  "), F.col("p_name"), F.lit(" \t the "), F.col("p_type"), F.lit("-1 "))
    rows = table(spark, d, "part").select("p_partkey", name.alias("x"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("b"))
    words = T.content_words("x", _STOP)
    return rows.select("p_partkey", T.name_key("x").alias("name_key"), T.clean_field("b").alias("brand"), N.word_count("x").cast("long").alias("n_words"), F.array_join(words, " ").alias("words"), F.array_join(T.distinct_words(words, F.array(F.lit("standard"))), " ").alias("distinct_words"))


def entity_flags(spark: SparkSession, d: str) -> DataFrame:
    """Entities, and entities inside words, in raw pages."""
    pages = table(spark, d, "pages")
    return pages.select("page_id", T.has_entity("html").alias("has_entity"), T.has_inner_entity("html").alias("inner_entity"))


def mention_places(spark: SparkSession, d: str) -> DataFrame:
    """Where a word stands in each document, case ignored, and how many words begin alike."""
    docs = table(spark, d, "documents")
    places = T.find_all(F.lit("tion"), "text")
    return docs.select("doc_id", F.when(F.col("text").isNull(), -1).otherwise(F.size(places)).cast("long").alias("n"), F.coalesce(F.get(places, F.lit(0)), F.lit(-1)).cast("long").alias("first"), F.coalesce(F.array_max(places), F.lit(-1)).cast("long").alias("last"))


def source_classes(spark: SparkSession, d: str) -> DataFrame:
    """Parts of allowed kinds, and those of which the kind isn't followed by a ball."""
    parts = table(spark, d, "part").select("p_partkey", "p_type")
    kind = rf"\b({'|'.join(_CLASSES)})\b"
    return parts.select("p_partkey", P.has("p_type", kind).alias("allowed"), F.size(T.suppressed("p_type", rf"(STANDARD|SMALL|LARGE)", ("POLISHED", "PLATED"))).cast("long").alias("kept"))


def number_fields(spark: SparkSession, d: str) -> DataFrame:
    """Connectivity blocks, flat keys, halves to even, midpoints of logarithms."""
    rows = table(spark, d, "orders").select("o_orderkey", F.upper(F.md5(F.col("o_orderkey").cast("string"))).alias("h"), "o_totalprice", "o_custkey")
    key = F.concat(F.substring("h", 1, 14), F.when(F.col("o_orderkey") % 2 == 0, F.lit("-UHFFFAOYSA-")).otherwise(F.lit("-ABCDEFGHIJ-")), F.lit("N"))
    half = (F.col("o_orderkey") % 1000).cast("decimal(18,3)") / F.lit(8).cast("decimal(18,3)")
    mid = N.log_midpoint(F.col("o_custkey") + 1.0, F.col("o_orderkey") + 1.0)
    return rows.select("o_orderkey", N.connectivity(key).alias("block"), N.without_stereo(key).alias("flat"), N.round_half_even(half.cast("decimal(18,3)"), 2).cast("double").alias("half_even"), F.round(mid, 4).alias("midpoint"))


def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as JSON lines, written and read back."""
    where = _folder(spark)
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sinks.write_json(rows, where)
    return readers.json_lines(spark, where, rows.schema)


def tsv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Nations as tab-separated values, with a name that holds a tab and a line end, written and read back."""
    where = _folder(spark)
    rows = table(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit("\t\n"), "n_name").alias("n_name"), "n_regionkey")
    sinks.write_tsv(rows, where, ["n_nationkey"])
    return readers.tsv(spark, where, rows.schema)


def markdown_lists(spark: SparkSession, d: str) -> DataFrame:
    """Nations under their regions, as Markdown."""
    rows = table(spark, d, "nation").select("n_regionkey", "n_name", "n_nationkey")
    return sinks.markdown_sections(rows, "n_regionkey", F.concat(F.col("n_name"), F.lit(" ("), F.col("n_nationkey").cast("string"), F.lit(")")), ["n_name", "n_nationkey"])


_X = "'  ' || p_name || ' ' || chr(9) || ' the ' || p_type || '-1 '"
_FLAT = rf"trim(regexp_replace({_X}, '\s+', ' ', 'g'))"
PLANS: Plans = {
    "text_fields": (
        text_fields,
        rf"WITH p AS (SELECT p_partkey, lower({_FLAT}) AS k, CASE WHEN p_partkey % 3 <> 0 THEN p_brand ELSE '' END AS b FROM part), "
        rf"w AS (SELECT *, list_filter(list_transform(string_split_regex(k, '[^\p{{L}}\p{{N}}-]+'), lambda x: regexp_replace(x, '^-+|-+$', '', 'g')), lambda x: length(x) > 2 AND x NOT IN {_STOP} AND NOT regexp_matches(x, '^\d+$')) AS ws FROM p) "
        r"SELECT p_partkey, k AS name_key, b AS brand, len(string_split(k, ' '))::BIGINT AS n_words, array_to_string(ws, ' ') AS words, "
        r"array_to_string(list_filter(ws, lambda x, i: x <> 'standard' AND list_position(ws, x) = i), ' ') AS distinct_words FROM w",
    ),
    "entity_flags": (entity_flags, r"SELECT page_id, regexp_matches(html, '&(#\d+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);') AS has_entity, regexp_matches(html, '[A-Za-z]&(#\d+|#x[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);[A-Za-z]') AS inner_entity FROM pages"),
    "mention_places": (
        mention_places,
        "WITH p AS (SELECT doc_id, text, string_split(lower(text), 'tion') AS p FROM documents) SELECT doc_id, coalesce(len(p) - 1, -1)::BIGINT AS n, CASE WHEN len(p) > 1 THEN length(p[1]) ELSE -1 END::BIGINT AS first, "
        "CASE WHEN len(p) > 1 THEN length(text) - length(p[-1]) - 4 ELSE -1 END::BIGINT AS last FROM p",
    ),
    "source_classes": (
        source_classes,
        r"SELECT p_partkey, regexp_matches(p_type, '\b(STEEL|COPPER)\b') AS allowed, (CASE WHEN regexp_matches(p_type, '(STANDARD|SMALL|LARGE)') AND NOT regexp_matches(p_type, '(STANDARD|SMALL|LARGE)\s+(POLISHED|PLATED)\b') THEN 1 ELSE 0 END)::BIGINT AS kept FROM part",
    ),
    "number_fields": (
        number_fields,
        "SELECT o_orderkey, substr(upper(md5(o_orderkey::VARCHAR)), 1, 14) AS block, o_orderkey % 2 = 0 AS flat, round_even((o_orderkey % 1000) / 8.0::DOUBLE, 2) AS half_even, round(exp((ln(o_custkey + 1.0::DOUBLE) + ln(o_orderkey + 1.0::DOUBLE)) / 2), 4) AS midpoint FROM orders",
    ),
    "json_round_trip": (json_round_trip, "SELECT s_suppkey, s_name, s_nationkey FROM supplier"),
    "tsv_round_trip": (tsv_round_trip, "SELECT n_nationkey, n_name || ' ' || n_name AS n_name, n_regionkey FROM nation"),
    "markdown_lists": (markdown_lists, "SELECT n_regionkey, '## ' || n_regionkey || chr(10) || chr(10) || string_agg('- ' || n_name || ' (' || n_nationkey || ')', chr(10) ORDER BY n_name, n_nationkey) || chr(10) AS section FROM nation GROUP BY n_regionkey"),
}
