"""Review rows carried over rebuilds, lookups over several routes, neighbours in context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import joins as J
from ..session import table
from .base import SENTENCES_SQL, VOCABULARY_SQL, Plans, sentences, vocabulary


def candidates(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a rebuilt review queue: an order's key and the part as its sentence."""
    return table(spark, d, "lineitem").where(F.col("l_linenumber") <= 2).select(F.col("l_orderkey").alias("source_id"), F.col("l_partkey").alias("sentence")).distinct()


def decided(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a decision from an earlier build; parent and splits share a key."""
    rows = table(spark, d, "lineitem").where((F.col("l_linenumber") <= 3) & (F.col("l_returnflag") != "N"))
    return rows.select(F.col("l_orderkey").alias("source_id"), F.col("l_partkey").alias("sentence"), F.when(F.col("l_returnflag") == "R", "reject").otherwise("approve").alias("decision"), F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("split_of")).distinct()


def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    out = J.carry_forward(candidates(spark, d), decided(spark, d), ["source_id", "sentence"], ["decision"], "split_of")
    return out.groupBy(F.coalesce("decision", F.lit("undecided")).alias("decision"), "copy").agg(F.count("*").alias("n"))


def orphans(spark: SparkSession, d: str) -> DataFrame:
    return decided(spark, d).join(candidates(spark, d), ["source_id", "sentence"], "left_anti").groupBy("decision").agg(F.count("*").alias("n"))


def retired_anti(spark: SparkSession, d: str) -> DataFrame:
    """Sentences that aren't retired; the key is the document and the normalised sentence."""
    retired = sentences(spark, d).where(F.pmod("doc_id", F.lit(7)) == 0).where(F.col("pos") % 2 == 0).select("doc_id", T.name_key("s").alias("k"))
    return sentences(spark, d).withColumn("k", T.name_key("s")).join(retired, ["doc_id", "k"], "left_anti").groupBy("doc_id").agg(F.count("*").alias("n"))


def unique_match_status(spark: SparkSession, d: str) -> DataFrame:
    queue = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))
    batch = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit(1).alias("n"))
    return J.unique_match(batch, queue, ["k", "n"]).groupBy("status").agg(F.count("*").alias("n"))


def positional(spark: SparkSession, d: str) -> DataFrame:
    """Proposals are joined by place, and count only if the text is still the same there."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, d, "conversations").select("conv_id", F.row_number().over(order).alias("n"), "text")
    proposals = rows.select("conv_id", "n", F.when(F.col("n") % 3 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("seen"))
    return rows.join(proposals, ["conv_id", "n"]).groupBy((F.col("text") == F.col("seen")).alias("same")).agg(F.count("*").alias("n"))


def multi_route(spark: SparkSession, d: str) -> DataFrame:
    """Parts meet suppliers by key, then by name, then by a squashed name; the first route that finds one counts."""
    parts = table(spark, d, "part").select("p_partkey", "p_name", T.squash("p_name").alias("k1"), (F.col("p_partkey") * 3).alias("by_key"))
    other = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), T.squash("p_name").alias("k2"))
    even, odd = other.where(F.col("id") % 2 == 0), other.where(F.col("id") % 2 == 1)
    long = F.when(F.length("k1") > 5, F.col("k1"))
    routes = [("key", even, F.col("by_key"), F.col("id"), "id"), ("name", odd.where(F.col("id") % 5 == 0), F.col("p_name"), F.col("name"), "id"), ("loose", odd, long, F.col("k2"), "id")]
    return J.first_route(parts, routes, "p_partkey").groupBy(F.coalesce("route", F.lit("none")).alias("route")).agg(F.count("*").alias("n"), F.coalesce(F.sum("match"), F.lit(0)).cast("long").alias("total"))


def two_hop(spark: SparkSession, d: str) -> DataFrame:
    """Customer -> orders -> parts: the least part reached."""
    orders, items = table(spark, d, "orders"), table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("custkey")).agg(F.min("l_partkey").alias("identity"))


def ambiguous_lookup(spark: SparkSession, d: str) -> DataFrame:
    lookup = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("name"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("identity"))
    return J.unambiguous(lookup, "name", "identity", F.substring("identity", 1, 7)).groupBy("verdict").agg(F.count("*").alias("names"), F.sum("identities").alias("identities"), F.min("pick").alias("least"))


def todo_anti(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    done = table(spark, d, "orders").where(F.col("o_totalprice") > 100000).select(F.col("o_custkey").alias("k"))
    return known.join(done, "k", "left_anti")


def membership(spark: SparkSession, d: str) -> DataFrame:
    """How much of a sample is held already."""
    held = table(spark, d, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("k")).distinct()
    sample = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    out = sample.join(held.withColumn("held", F.lit(1)), "k", "left").agg(F.count("*").alias("sampled"), F.count_if(F.col("held").isNull()).alias("new"))
    return out.select("sampled", "new", F.round(100 * (1 - F.col("new") / F.col("sampled")), 4).alias("overlap_pct"))


def witness(spark: SparkSession, d: str) -> DataFrame:
    """Names that another spelling (equal when squashed) backs: all of them must agree."""
    words = table(spark, d, "documents").select(F.explode(F.array_distinct(T.words("text"))).alias("w"), "lang").where(F.rlike("w", F.lit("^[a-z]{5,}$"))).groupBy("w").agg(F.min("lang").alias("lang"))
    keyed = words.withColumn("k", T.squash("w"))
    group = keyed.groupBy("k").agg(F.count("*").alias("spellings"), F.countDistinct("lang").alias("langs")).where(F.col("spellings") > 1)
    return group.groupBy("spellings", (F.col("langs") == 1).alias("agree")).agg(F.count("*").alias("n"))


def previous_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Sentences without a name and the nearest of the two before them that has one."""
    rows = sentences(spark, d)
    out = J.previous_match(rows, "doc_id", "pos", "s", F.rlike("s", F.lit("[0-9]")), 2, F.length("s") > 600)
    return out.where(~F.rlike("s", F.lit("[0-9]")) & F.col("antecedent").isNotNull()).select("doc_id", "pos", F.md5("antecedent").alias("antecedent"))


def last_turns(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", F.lag("role", 1).over(order).alias("before"), F.lag("role", 2).over(order).alias("before_that"))


def disjoint(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of other forms that don't overlap the document's first mention of an own one; intervals are word ranges."""
    words = table(spark, d, "documents").select("doc_id", F.posexplode(T.words("text")).alias("pos", "w")).join(F.broadcast(vocabulary(spark)), F.col("w") == F.col("form"))
    link = F.when(F.col("tag") == "link", F.col("pos"))
    before = F.last(link, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    after = F.last(link, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0))
    placed = words.select("doc_id", "tag", "pos", before.alias("before"), after.alias("after"))
    near = F.coalesce(F.col("pos") - F.col("before") <= 1, F.lit(False)) | F.coalesce(F.col("after") - F.col("pos") <= 1, F.lit(False))
    other = F.col("tag") != "link"
    return placed.groupBy("doc_id").agg(F.count_if(other).alias("others"), F.count_if(other & ~near).alias("free"))


def nearest(spark: SparkSession, d: str) -> DataFrame:
    """For each first mention of a tag the distance in words to the nearest first mention of another."""
    words = table(spark, d, "documents").select("doc_id", F.posexplode(T.words("text")).alias("pos", "w")).join(F.broadcast(vocabulary(spark)), F.col("w") == F.col("form")).groupBy("doc_id", "tag").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy("doc_id").orderBy("pos")
    gap = F.least(F.col("pos") - F.lag("pos").over(w), F.lead("pos").over(w) - F.col("pos"))
    return words.select("doc_id", "tag", gap.cast("long").alias("gap")).where(F.col("gap").isNotNull()).groupBy("tag").agg(F.min("gap").alias("least"), F.sum("gap").alias("total"))


def lookup_flag(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "supplier").where(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("listed"))
    return table(spark, d, "lineitem").join(listed, "l_suppkey", "left").groupBy("l_returnflag", F.col("listed").isNotNull().alias("is_listed")).agg(F.count("*").alias("n"))


def cross_check(spark: SparkSession, d: str) -> DataFrame:
    """Two resolvers over the same names: agree, different, one has none."""
    a = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderstatus").alias("x"))
    b = table(spark, d, "orders").where(F.col("o_totalprice") > 50000).groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderstatus").alias("y"))
    verdict = F.when(F.col("y").isNull(), "none").when(F.col("x") == F.col("y"), "agree").otherwise("different")
    return a.join(b, "k", "left").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def codes(spark: SparkSession, d: str) -> DataFrame:
    """First list of allergens, by any code of a row's list, that has one."""
    lists = table(spark, d, "part").select("p_partkey", F.explode(F.split(F.concat_ws(";", F.col("p_size").cast("string"), (F.col("p_partkey") % 50).cast("string")), ";")).alias("code"))
    listed = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    return lists.join(F.broadcast(listed), "code").groupBy("p_partkey").agg(F.min("n_name").alias("first_list"), F.count("*").alias("hits"))


def mentions_join(spark: SparkSession, d: str) -> DataFrame:
    """Entity names in texts by one alternation rather than a nested loop."""
    names = ["token", "license", "copyright", "password"]
    found = table(spark, d, "documents").select("doc_id", F.explode(T.mentions("text", r"(?i)(token|license|copyright|password)")).alias("name"))
    return found.where(F.col("name").isin(names)).groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


def edits(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag"))
    plan = table(spark, d, "orders").where(F.col("o_orderkey") % 5 == 0).select(F.col("o_orderkey").alias("k"), F.lit(1).alias("n"), F.lit(1).alias("expected"), F.lit("X").alias("new"))
    return J.edit_plan(rows, plan, ["k", "n"], "expected", "flag", "new", "note").groupBy("edit_status", "flag", F.coalesce("note", F.lit("")).alias("note")).agg(F.count("*").alias("n"))


def before_after(spark: SparkSession, d: str) -> DataFrame:
    before = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    after = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return J.symmetric_difference(before, after)


def sets(spark: SparkSession, d: str) -> DataFrame:
    """Two methods of listing the same ids: missed, extra, both, union."""
    a = table(spark, d, "orders").where(F.col("o_totalprice") > 60000).select("o_custkey").distinct().withColumn("a", F.lit(1))
    b = table(spark, d, "orders").where(F.col("o_orderstatus") == "O").select("o_custkey").distinct().withColumn("b", F.lit(1))
    return a.join(b, "o_custkey", "full").agg(F.count_if(F.col("a").isNull()).alias("missed"), F.count_if(F.col("b").isNull()).alias("extra"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both_have"), F.count("*").alias("together"))


_C = "WITH c AS (SELECT DISTINCT l_orderkey AS source_id, l_partkey AS sentence FROM lineitem WHERE l_linenumber <= 2), d AS (SELECT DISTINCT l_orderkey AS source_id, l_partkey AS sentence, CASE WHEN l_returnflag = 'R' THEN 'reject' ELSE 'approve' END AS decision, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS split_of FROM lineitem WHERE l_linenumber <= 3 AND l_returnflag <> 'N')"
_W = rf"WITH w AS (SELECT doc_id, unnest(l) AS w, unnest(range(len(l))) AS pos FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+') AS l FROM documents)), v AS (SELECT * FROM w JOIN {VOCABULARY_SQL} ON w.w = form)"
_SQUASH = "translate(regexp_replace(lower({0}), '[^a-z0-9]', '', 'g'), 'loi', '101')"
PLANS: Plans = {
    "carry_forward": (carry_forward, f"{_C}, j AS (SELECT c.*, decision, row_number() OVER (PARTITION BY source_id, sentence ORDER BY split_of NULLS FIRST, decision) AS copy FROM c LEFT JOIN d USING (source_id, sentence)) SELECT coalesce(decision, 'undecided') AS decision, copy::INTEGER AS copy, count(*) AS n FROM j GROUP BY 1, 2"),
    "orphans": (orphans, f"{_C} SELECT decision, count(*) AS n FROM d WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source_id = d.source_id AND c.sentence = d.sentence) GROUP BY decision"),
    "retired_anti": (retired_anti, rf"WITH {SENTENCES_SQL}, k AS (SELECT *, lower(trim(regexp_replace(s, '\s+', ' ', 'g'))) AS k FROM s), r AS (SELECT DISTINCT doc_id, k FROM k WHERE doc_id % 7 = 0 AND pos % 2 = 0) SELECT doc_id, count(*) AS n FROM k WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = k.doc_id AND r.k = k.k) GROUP BY doc_id"),
    "unique_match_status": (unique_match_status, "WITH f AS (SELECT l_orderkey AS k, count(*) AS found FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) SELECT CASE WHEN found IS NULL THEN 'none' WHEN found = 1 THEN 'one' ELSE 'many' END AS status, count(*) AS n FROM orders LEFT JOIN f ON o_orderkey = k GROUP BY 1"),
    "positional_guard": (positional, "WITH r AS (SELECT text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) SELECT (n % 3 <> 0) AS same, count(*) AS n FROM r GROUP BY 1"),
    "multi_route_match": (multi_route, f"WITH p AS (SELECT *, {_SQUASH.format('p_name')} AS k FROM part), a AS (SELECT p.p_partkey, (SELECT min(e.p_partkey) FROM p e WHERE e.p_partkey % 2 = 0 AND e.p_partkey = p.p_partkey * 3) AS r0 FROM p), b AS (SELECT p.p_partkey, min(o.p_partkey) AS r1 FROM p JOIN p o ON o.p_partkey % 2 = 1 AND o.p_partkey % 5 = 0 AND o.p_name = p.p_name GROUP BY 1), c AS (SELECT p.p_partkey, min(o.p_partkey) AS r2 FROM p JOIN p o ON o.p_partkey % 2 = 1 AND o.k = p.k AND length(p.k) > 5 GROUP BY 1) SELECT CASE WHEN r0 IS NOT NULL THEN 'key' WHEN r1 IS NOT NULL THEN 'name' WHEN r2 IS NOT NULL THEN 'loose' ELSE 'none' END AS route, count(*) AS n, coalesce(sum(coalesce(r0, r1, r2)), 0)::BIGINT AS total FROM a LEFT JOIN b USING (p_partkey) LEFT JOIN c USING (p_partkey) GROUP BY 1"),
    "two_hop_min_identity": (two_hop, "SELECT o_custkey AS custkey, min(l_partkey) AS identity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1"),
    "ambiguous_lookup": (ambiguous_lookup, "WITH l AS (SELECT l_orderkey AS name, lpad(l_suppkey::VARCHAR, 8, '0') AS identity FROM lineitem), g AS (SELECT name, count(DISTINCT identity) AS identities, count(DISTINCT identity[1:7]) = 1 AS ok, min(identity) AS least FROM l GROUP BY name) SELECT CASE WHEN ok THEN 'accepted' ELSE 'ambiguous' END AS verdict, count(*) AS names, sum(identities)::BIGINT AS identities, min(CASE WHEN ok THEN least END) AS least FROM g GROUP BY 1"),
    "todo_anti": (todo_anti, "SELECT c_custkey AS k FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)"),
    "membership_overlap": (membership, "WITH h AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') SELECT count(*) AS sampled, count(*) FILTER (k IS NULL) AS new, round(100 * (1 - count(*) FILTER (k IS NULL)::DOUBLE / count(*)), 4) AS overlap_pct FROM customer LEFT JOIN h ON c_custkey = k"),
    "witness_agreement": (witness, rf"WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w, lang FROM documents), m AS (SELECT w, min(lang) AS lang FROM w WHERE regexp_matches(w, '^[a-z]{{5,}}$') GROUP BY w), g AS (SELECT {_SQUASH.format('w')} AS k, count(*) AS spellings, count(DISTINCT lang) AS langs FROM m GROUP BY 1 HAVING count(*) > 1) SELECT spellings, langs = 1 AS agree, count(*) AS n FROM g GROUP BY 1, 2"),
    "prev_sentence_pairs": (previous_pairs, rf"WITH {SENTENCES_SQL}, b2 AS (SELECT doc_id, pos, s, lag(s, 1) OVER w AS a, lag(s, 2) OVER w AS b FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), f AS (SELECT *, CASE WHEN length(a) > 600 THEN NULL WHEN regexp_matches(a, '[0-9]') THEN a WHEN length(b) > 600 THEN NULL WHEN regexp_matches(b, '[0-9]') THEN b END AS antecedent FROM b2) SELECT doc_id, pos, md5(antecedent) AS antecedent FROM f WHERE NOT regexp_matches(s, '[0-9]') AND antecedent IS NOT NULL"),
    "look_back_turns": (last_turns, "SELECT conv_id, turn, lag(role, 1) OVER w AS before, lag(role, 2) OVER w AS before_that FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"),
    "interval_disjoint_mentions": (disjoint, f"{_W}, o AS (SELECT doc_id, pos FROM v WHERE tag = 'link') SELECT v.doc_id, count(*) FILTER (tag <> 'link') AS others, count(*) FILTER (tag <> 'link' AND NOT EXISTS (SELECT 1 FROM o WHERE o.doc_id = v.doc_id AND abs(o.pos - v.pos) <= 1)) AS free FROM v GROUP BY v.doc_id"),
    "nearest_mention": (nearest, f"{_W}, f AS (SELECT doc_id, tag, min(pos) AS pos FROM v GROUP BY doc_id, tag), g AS (SELECT tag, least(pos - lag(pos) OVER w, lead(pos) OVER w - pos) AS gap FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) SELECT tag, min(gap) AS least, sum(gap)::BIGINT AS total FROM g WHERE gap IS NOT NULL GROUP BY tag"),
    "lookup_flag": (lookup_flag, "SELECT l_returnflag, s_suppkey IS NOT NULL AS is_listed, count(*) AS n FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey GROUP BY 1, 2"),
    "resolver_cross_check": (cross_check, "WITH a AS (SELECT o_custkey AS k, min(o_orderstatus) AS x FROM orders GROUP BY 1), b AS (SELECT o_custkey AS k, max(o_orderstatus) AS y FROM orders WHERE o_totalprice > 50000 GROUP BY 1) SELECT CASE WHEN y IS NULL THEN 'none' WHEN x = y THEN 'agree' ELSE 'different' END AS verdict, count(*) AS n FROM a LEFT JOIN b USING (k) GROUP BY 1"),
    "any_code_semi": (codes, "WITH l AS (SELECT p_partkey, unnest([p_size::VARCHAR, (p_partkey % 50)::VARCHAR]) AS code FROM part) SELECT p_partkey, min(n_name) AS first_list, count(*) AS hits FROM l JOIN nation ON code = n_nationkey::VARCHAR GROUP BY 1"),
    "name_contains_join": (mentions_join, "WITH f AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), 'token|license|copyright|password')) AS name FROM documents) SELECT name, count(*) AS n, count(DISTINCT doc_id) AS docs FROM f GROUP BY name"),
    "edit_plan_expected_counts": (edits, "WITH r AS (SELECT l_orderkey AS k, l_linenumber AS n, l_returnflag AS flag FROM lineitem), f AS (SELECT k, n, count(*) AS found FROM r GROUP BY 1, 2), e AS (SELECT o_orderkey AS k, 1 AS n FROM orders WHERE o_orderkey % 5 = 0), p AS (SELECT e.k, e.n, coalesce(found = 1, false) AS fits FROM e LEFT JOIN f USING (k, n)), o AS (SELECT CASE WHEN fits THEN 'X' ELSE flag END AS flag, CASE WHEN fits THEN 'was ' || flag ELSE '' END AS note, CASE WHEN fits THEN 'applied' WHEN fits IS NOT NULL THEN 'refused' ELSE 'none' END AS edit_status FROM r LEFT JOIN p USING (k, n)) SELECT edit_status, flag, note, count(*) AS n FROM o GROUP BY 1, 2, 3"),
    "before_after_diff": (before_after, "WITH b AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, count(*) AS n FROM orders GROUP BY 1) SELECT *, 'left' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT *, 'right' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)"),
    "two_method_completeness": (sets, "WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 60000), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O') SELECT count(*) FILTER (a.o_custkey IS NULL) AS missed, count(*) FILTER (b.o_custkey IS NULL) AS extra, count(*) FILTER (a.o_custkey IS NOT NULL AND b.o_custkey IS NOT NULL) AS both_have, count(*) AS together FROM a FULL JOIN b USING (o_custkey)"),
}
