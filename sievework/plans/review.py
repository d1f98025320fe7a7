"""Flags, holds, queues, identities that fall through, and the numbers that reports quote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import predicates as P
from ..operators.rules import DATA_RULES, first_reason
from ..operators.order import running
from ..session import table
from .base import SENTENCES_SQL, Plans, sentences, sql_has, sql_reason
from .dedupe import GROUPS_SQL, components

WORKS = (("address", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"), ("mail", r"@[a-z]"), ("phone", r"\([0-9]{3}\)"))
HINTS = ("license", "copyright", "token", "idiot", "scum")


def first_label(spark: SparkSession, d: str) -> DataFrame:
    """Which kind of foreign matter a document has: the first that matches."""
    return table(spark, d, "documents").groupBy(F.coalesce(P.first_label("text", WORKS), F.lit("none")).alias("label")).agg(F.count("*").alias("n"))


def all_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.array_join(P.all_labels("text", WORKS), ";").alias("flags")).agg(F.count("*").alias("n"))


def hint_lists(spark: SparkSession, d: str) -> DataFrame:
    found = P.hints("text", HINTS)
    return table(spark, d, "documents").select("doc_id", F.array_join(found, ";").alias("hits"), (F.size(found) > 0).alias("flagged")).where("flagged")


def held_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that wait for review unless approved; a null decision keeps them waiting."""
    orders = table(spark, d, "orders").select(F.col("o_orderpriority").startswith("1").alias("needs_review"), F.when(F.col("o_orderstatus") == "F", "approve").when(F.col("o_orderstatus") == "O", "reject").alias("decision"))
    admitted = ~F.col("needs_review") | F.col("decision").eqNullSafe("approve")
    return orders.groupBy("needs_review", admitted.alias("admitted")).agg(F.count("*").alias("n"))


def triage(spark: SparkSession, d: str) -> DataFrame:
    """Marks, never deletes: by source, else by a table of name and kind."""
    pairs = spark.range(1).select(F.explode(F.array(F.struct(F.lit("ASIA").alias("r_name"), F.lit(8).alias("n_nationkey"), F.lit("wrong region").alias("reason")))).alias("p")).select("p.*")
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return P.triage(nations, "^(EUR|MID)", "r_name", pairs, ["r_name", "n_nationkey"])


def queue_order(spark: SparkSession, d: str) -> DataFrame:
    """Proposals first, then productive rows, then the queue's own order; nothing is filtered."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_orderkey") % 9 == 0).alias("proposal"), (F.col("o_orderstatus") == "F").alias("productive"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")).alias("queue_order"))
    order = [F.desc("proposal"), F.desc("productive"), F.coalesce("queue_order", F.lit(0)), F.col("o_orderkey")]
    return running(rows, ["o_orderpriority"], order).select("o_orderkey", "place")


def split_rows(spark: SparkSession, d: str) -> DataFrame:
    """A row that carries two entities becomes parent and child."""
    rows = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, F.array(F.lit(None).cast("int"), F.lit(1))).otherwise(F.array(F.lit(None).cast("int"))).alias("splits"))
    return rows.select("s_suppkey", F.explode("splits").alias("split_of")).select("s_suppkey", F.coalesce("split_of", F.lit(0)).alias("split_of"))


def fallthrough(spark: SparkSession, d: str) -> DataFrame:
    """Two identity maps; the first that knows a key wins."""
    a = table(spark, d, "orders").where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderkey").alias("a"))
    b = table(spark, d, "customer").where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("k"), (F.col("c_custkey") + 900000).alias("b"))
    return a.join(b, "k", "full").select("k", F.coalesce("a", "b").alias("identity"))


def label_priority(spark: SparkSession, d: str) -> DataFrame:
    """One label of several kinds: the kind of least rank, then the least text."""
    names = table(spark, d, "part").select(F.col("p_size").alias("k"), F.lit(2).alias("rank"), F.col("p_type").alias("label")).unionByName(table(spark, d, "part").where(F.col("p_partkey") % 3 == 0).select(F.col("p_size").alias("k"), F.lit(1).alias("rank"), F.col("p_brand").alias("label")))
    return names.groupBy("k").agg(F.min(F.struct("rank", "label")).alias("m")).select("k", "m.rank", "m.label")


def referential(spark: SparkSession, d: str) -> DataFrame:
    """Keys that a catalogue doesn't have; must be none for a release."""
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.count("*").alias("missing"))


def transfer(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of dropped copies that the kept document of their group has word for word."""
    groups = components(spark, d).select("doc", "component")
    rows = sentences(spark, d).select("doc_id", "s").distinct().join(groups, F.col("doc_id") == F.col("doc"))
    kept = rows.where(F.col("doc_id") == F.col("component")).select("component", "s").distinct()
    lost = rows.where(F.col("doc_id") != F.col("component"))
    return lost.join(kept.withColumn("there", F.lit(True)), ["component", "s"], "left").groupBy("doc_id").agg(F.count("*").alias("sentences"), F.count_if("there").alias("transferred"))


def live_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of rows that aren't excluded, and of approved ones of another layer."""
    a = table(spark, d, "orders").where(F.col("o_orderstatus") != "P").select(F.col("o_custkey").alias("k"))
    b = table(spark, d, "orders").where((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0)).select(F.col("o_custkey").alias("k"))
    return a.union(b).distinct()


def drift(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of a vocabulary: added, missing, together."""
    words = table(spark, d, "documents").select("source", F.explode(F.array_distinct(T.words("text"))).alias("w")).where(F.length("w") > 3)
    old, new = words.where(F.col("source") == "src0").select("w").distinct().withColumn("a", F.lit(1)), words.where(F.col("source") == "src1").select("w").distinct().withColumn("b", F.lit(1))
    return old.join(new, "w", "full").agg(F.count_if(F.col("a").isNull()).alias("added"), F.count_if(F.col("b").isNull()).alias("missing"), F.count("*").alias("together"))


def reasons(spark: SparkSession, d: str) -> DataFrame:
    """The five most frequent reasons, shortened."""
    judged = sentences(spark, d).withColumn("why", F.substring(first_reason("s", DATA_RULES), 1, 10))
    return judged.groupBy("why").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "why").limit(5)


def anaphora(spark: SparkSession, d: str) -> DataFrame:
    """Sentences that begin with a pointing word, by language."""
    return sentences(spark, d).groupBy("lang").agg(F.count_if(F.rlike("s", F.lit(r"(?i)^(the|this|that|les|der|el)[^\p{L}\p{N}_]"))).alias("pointing"), F.count("*").alias("n"))


def productive(spark: SparkSession, d: str) -> DataFrame:
    """Sentences with a name-like token and a word of the vocabulary."""
    both = F.rlike("s", F.lit("[A-Za-z]+(tion|ment|heit)")) & F.rlike("s", F.lit(r"(?i)(^|[^\p{L}\p{N}_])(of|und|que)($|[^\p{L}\p{N}_])"))
    return sentences(spark, d).groupBy("source").agg(F.count_if(both).alias("productive"))


def pool(spark: SparkSession, d: str) -> DataFrame:
    """Rows fit for a hand-drawn sample: no digits, no noise, three for each source."""
    fit = sentences(spark, d).where(~F.rlike("s", F.lit("[0-9]")) & ~F.rlike("s", F.lit(r"[#$%&*|!]")) & (F.length("s") > 60))
    return fit.withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("doc_id", "pos"))).where(F.col("n") <= 3).select("source", "n", "doc_id", "pos")


def facet_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.split("p_type", " ").alias("tags"), "p_retailprice")
    return P.facets(rows, "tags", ["STANDARD"], "p_retailprice", 950, 1400).where(T.contains_all(F.array_join("tags", " "), F.lit("standard"))).select("p_partkey")


def paging(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey").offset(80).limit(80).select("c_custkey")


def merged_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the same entity and quote become one, with the union of their tags."""
    rows = table(spark, d, "lineitem")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ";").alias("flags"), F.array_join(F.array_sort(F.collect_set(F.col("l_linestatus"))), ";").alias("states"), F.count("*").alias("n")).where(F.col("n") > 1)


def best_spelling(spark: SparkSession, d: str) -> DataFrame:
    """Of the spellings of a key the one of the best tier; whether their identities disagree."""
    rows = table(spark, d, "part").select((F.col("p_size") % 20).alias("k"), "p_name", F.when(F.col("p_partkey") % 3 == 0, 0).otherwise(1).alias("tier"), F.substring("p_brand", 1, 7).alias("block"))
    return rows.groupBy("k").agg(F.min(F.struct("tier", "p_name")).alias("b"), (F.countDistinct("block") > 1).alias("disagree")).select("k", F.col("b.p_name").alias("best"), "disagree")


def conformers(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates zipped and rounded, ids shifted to start at 0, both flattened to strings."""
    rows = table(spark, d, "supplier").select("s_suppkey", F.array(F.lit("C"), F.lit("O")).alias("el"), F.array(F.col("s_acctbal"), F.col("s_acctbal") / 2).alias("x"), F.array(F.lit(1), F.lit(2)).alias("a"))
    atoms = F.transform(F.arrays_zip("el", "x"), lambda z: F.concat_ws(" ", z["el"], F.format_string("%.3f", z["x"])))
    return rows.select("s_suppkey", F.array_join(atoms, "; ").alias("atoms"), F.array_join(F.transform("a", lambda i: (i - 1).cast("string")), "-").alias("bond"))


def spiral(spark: SparkSession, d: str) -> DataFrame:
    """Places on a spiral by order in the group."""
    w = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    j = F.row_number().over(w) - 1
    return table(spark, d, "supplier").select("s_suppkey", F.round(F.sqrt(j + 0.5) * F.cos(j * 2.399963), 6).alias("x"), F.round(F.sqrt(j + 0.5) * F.sin(j * 2.399963), 6).alias("y"))


def productivity(spark: SparkSession, d: str) -> DataFrame:
    """Sentences that speak of a tag below the bar."""
    terms = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(a).alias("form"), F.lit(b).alias("have")) for a, b in (("the", 50), ("avec", 12), ("nicht", 29))))).alias("t")).select("t.*").where(F.col("have") < 30)
    words = sentences(spark, d).select("doc_id", "pos", F.explode(F.array_distinct(T.words("s"))).alias("w"))
    return words.join(F.broadcast(terms), F.col("w") == F.col("form")).groupBy("form").agg(F.count("*").alias("sentences"))


def support_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Kinds with enough support as columns; the number of kinds counts all."""
    rows = table(spark, d, "events").select("user_id", "event_type").distinct()
    kept = ["click", "view"]
    out = rows.groupBy("user_id").agg(*(F.max((F.col("event_type") == k).cast("int")).alias(f"has_{k}") for k in kept), F.count("*").alias("n_kinds"))
    return out


def embedded_list(spark: SparkSession, d: str) -> DataFrame:
    """A list of strings inside a script, parsed out of it."""
    script = F.concat(F.lit('var VOCAB = ["'), F.concat_ws('","', "r_name", F.lower("r_name")), F.lit('"]; run();'))
    found = F.from_json(F.regexp_extract(script, r"VOCAB = (\[[^\]]*\])", 1), "array<string>")
    return table(spark, d, "region").select("r_regionkey", F.explode(found).alias("term"))


def wilson(spark: SparkSession, d: str) -> DataFrame:
    """A 95 % interval for the share of kept sentences in each language."""
    n, k, z = F.col("n").cast("double"), F.col("k").cast("double"), 1.96
    centre, half = (k / n + z * z / (2 * n)), z * F.sqrt(k / n * (1 - k / n) / n + z * z / (4 * n * n))
    counts = sentences(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.count_if(first_reason("s", DATA_RULES) == "kept").alias("k"))
    return counts.select("lang", F.round((centre - half) / (1 + z * z / n), 6).alias("low"), F.round((centre + half) / (1 + z * z / n), 6).alias("high"))


_L = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{label}'" for label, p in WORKS) + " ELSE 'none' END"
_S = f"WITH {SENTENCES_SQL}"
PLANS: Plans = {
    "first_label": (first_label, f"SELECT {_L} AS label, count(*) AS n FROM documents GROUP BY 1"),
    "all_flags": (all_flags, "SELECT concat_ws(';', " + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{label}' END" for label, p in WORKS) + ") AS flags, count(*) AS n FROM documents GROUP BY 1"),
    "hint_lists": (hint_lists, "SELECT doc_id, array_to_string(h, ';') AS hits, true AS flagged FROM (SELECT doc_id, list_filter([" + ", ".join(f"'{h}'" for h in HINTS) + "], lambda x: contains(lower(text), x)) AS h FROM documents) WHERE len(h) > 0"),
    "held_rows": (held_rows, "WITH o AS (SELECT starts_with(o_orderpriority, '1') AS needs_review, CASE o_orderstatus WHEN 'F' THEN 'approve' WHEN 'O' THEN 'reject' END AS decision FROM orders) SELECT needs_review, (NOT needs_review OR decision IS NOT DISTINCT FROM 'approve') AS admitted, count(*) AS n FROM o GROUP BY 1, 2"),
    "triage_marks": (triage, "WITH n AS (SELECT n_nationkey, n_name, r_name, regexp_matches(r_name, '^(EUR|MID)') AS p, (r_name = 'ASIA' AND n_nationkey = 8) AS q FROM nation JOIN region ON n_regionkey = r_regionkey) SELECT n_nationkey, n_name, r_name, (p OR q) AS excluded, CASE WHEN p THEN 'provenance' WHEN q THEN 'pair' END AS excluded_category, CASE WHEN p THEN 'source' WHEN q THEN 'wrong region' END AS excluded_reason FROM n"),
    "queue_order": (queue_order, "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey % 9 = 0 DESC, o_orderstatus = 'F' DESC, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey ELSE 0 END, o_orderkey)::INTEGER AS place FROM orders"),
    "split_rows": (split_rows, "SELECT s_suppkey, 0 AS split_of FROM supplier UNION ALL SELECT s_suppkey, 1 FROM supplier WHERE s_suppkey % 5 = 0"),
    "identity_fallthrough": (fallthrough, "WITH a AS (SELECT o_custkey AS k, min(o_orderkey) AS a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT c_custkey AS k, c_custkey + 900000 AS b FROM customer WHERE c_custkey % 2 = 0) SELECT k, coalesce(a, b) AS identity FROM a FULL JOIN b USING (k)"),
    "label_priority": (label_priority, "WITH n AS (SELECT p_size AS k, 2 AS rank, p_type AS label FROM part UNION ALL SELECT p_size, 1, p_brand FROM part WHERE p_partkey % 3 = 0) SELECT k, rank, label FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rank, label) AS r FROM n) WHERE r = 1"),
    "referential_check": (referential, "SELECT count(*) AS missing FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    "containment_transfer": (transfer, f"{GROUPS_SQL}, tr AS (SELECT DISTINCT s.doc_id, s.s, k.component FROM s JOIN k ON s.doc_id = k.doc), y AS (SELECT DISTINCT component, s FROM tr WHERE doc_id = component) SELECT tr.doc_id, count(*) AS sentences, count(y.s) AS transferred FROM tr LEFT JOIN y ON tr.component = y.component AND tr.s = y.s WHERE tr.doc_id <> tr.component GROUP BY tr.doc_id"),
    "live_keys": (live_keys, "SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 2 = 0"),
    "vocabulary_drift": (drift, r"WITH w AS (SELECT DISTINCT source, w FROM (SELECT source, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents) WHERE length(w) > 3), a AS (SELECT w FROM w WHERE source = 'src0'), b AS (SELECT w FROM w WHERE source = 'src1') SELECT count(*) FILTER (a.w IS NULL) AS added, count(*) FILTER (b.w IS NULL) AS missing, count(*) AS together FROM a FULL JOIN b USING (w)"),
    "top_reasons": (reasons, f"{_S} SELECT ({sql_reason('s')})[1:10] AS why, count(*) AS n FROM s GROUP BY 1 ORDER BY n DESC, why LIMIT 5"),
    "pointing_sentences": (anaphora, rf"{_S} SELECT lang, count(*) FILTER (regexp_matches(s, '(?i)^(the|this|that|les|der|el)[^\p{{L}}\p{{N}}_]')) AS pointing, count(*) AS n FROM s GROUP BY lang"),
    "productive_rows": (productive, f"{_S} SELECT source, count(*) FILTER (regexp_matches(s, '[A-Za-z]+(tion|ment|heit)') AND {sql_has('s', '(of|und|que)')}) AS productive FROM s GROUP BY source"),
    "sample_pool": (pool, f"{_S} SELECT source, n::INTEGER AS n, doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) AS n FROM s WHERE NOT regexp_matches(s, '[0-9]') AND NOT regexp_matches(s, '[#$%&*|!]') AND length(s) > 60) WHERE n <= 3"),
    "facet_filter": (facet_filter, "SELECT p_partkey FROM part WHERE list_contains(string_split(p_type, ' '), 'STANDARD') AND p_retailprice BETWEEN 950 AND 1400"),
    "paging": (paging, "SELECT c_custkey FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 80 OFFSET 80"),
    "merged_quotes": (merged_quotes, "SELECT l_orderkey, l_linenumber, string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS flags, string_agg(DISTINCT l_linestatus, ';' ORDER BY l_linestatus) AS states, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"),
    "best_spelling": (best_spelling, "WITH r AS (SELECT p_size % 20 AS k, p_name, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END AS tier, p_brand[1:7] AS block FROM part) SELECT k, arg_min(p_name, (tier, p_name)) AS best, count(DISTINCT block) > 1 AS disagree FROM r GROUP BY k"),
    "conformer_strings": (conformers, "SELECT s_suppkey, 'C ' || format('{:.3f}', s_acctbal) || '; O ' || format('{:.3f}', s_acctbal / 2) AS atoms, '0-1' AS bond FROM supplier"),
    "spiral_places": (spiral, "SELECT s_suppkey, round(sqrt(j + 0.5) * cos(j * 2.399963), 6) AS x, round(sqrt(j + 0.5) * sin(j * 2.399963), 6) AS y FROM (SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS j FROM supplier)"),
    "queue_productivity": (productivity, rf"{_S}, w AS (SELECT DISTINCT doc_id, pos, unnest(regexp_extract_all(lower(s), '\p{{L}}+')) AS w FROM s) SELECT w AS form, count(*) AS sentences FROM w WHERE w IN ('avec', 'nicht') GROUP BY 1"),
    "support_pivot": (support_pivot, "SELECT user_id, max((event_type = 'click')::INTEGER) AS has_click, max((event_type = 'view')::INTEGER) AS has_view, count(DISTINCT event_type) AS n_kinds FROM events GROUP BY 1"),
    "embedded_list": (embedded_list, "SELECT r_regionkey, r_name AS term FROM region UNION ALL SELECT r_regionkey, lower(r_name) FROM region"),
    "wilson_interval": (wilson, f"{_S}, c AS (SELECT lang, count(*)::DOUBLE AS n, count(*) FILTER (({sql_reason('s')}) = 'kept')::DOUBLE AS k FROM s GROUP BY lang), w AS (SELECT lang, n, k / n + 1.96 * 1.96 / (2 * n) AS c, 1.96 * sqrt(k / n * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n)) AS h FROM c) SELECT lang, round((c - h) / (1 + 1.96 * 1.96 / n), 6) AS low, round((c + h) / (1 + 1.96 * 1.96 / n), 6) AS high FROM w"),
}
