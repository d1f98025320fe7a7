"""Vectors, profiles, arrays and the rows of a release."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import identifiers as N
from ..functions import text as T
from ..operators import features as X
from ..session import stash, table
from .base import Plans

KINDS = ["click", "error", "purchase", "signup", "view"]


def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """The three nearest of all other vectors to each whose id is divisible by 50; queries and rows meet by blocks of both.

    Pairs with a vector that is null, of another length than most, or holds a null or no number are multiplied one by one.
    """
    rows = stash(table(spark, d, "embeddings").where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), X.unit("embedding").alias("v")))
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))
    most = rows.where(sound).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.withColumn("plain", sound & (F.size("v") == (most["n"] if most else -1)))
    queries = rows.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("plain").alias("asks_plain"))
    met = X.best_dots(queries.where("asks_plain").select("query_id", "q"), rows.where("plain").select("vec_id", "v"), 3)
    if not rows.where("NOT plain").isEmpty():
        for asked, held in ((queries, rows.where("NOT plain")), (queries.where("NOT asks_plain"), rows.where("plain"))):
            pairs = asked.hint("shuffle_replicate_nl").crossJoin(held).where(F.col("vec_id") != F.col("query_id"))
            met = met.unionByName(pairs.select("query_id", "vec_id", N.dot("q", "v").alias("score")))
    met = met.withColumn("score", F.round("score", 9))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 3).select("query_id", "rank", "vec_id", F.round("score", 6).alias("score"))


def profile_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = X.profiles(table(spark, d, "events"), "user_id", "event_type", KINDS)
    key = F.array_join(F.transform("profile", lambda x: F.round(x).cast("int").cast("string")), ",")
    return rows.groupBy(key.alias("profile")).agg(F.count("*").alias("users"), F.min("user_id").alias("least"))


def percentile_rescale(spark: SparkSession, d: str) -> DataFrame:
    out = X.clip_rescale(table(spark, d, "events").select("event_id", "event_type", "value"), "event_type", "value")
    return out.groupBy("event_type").agg(F.round(F.avg("scaled"), 6).alias("mean"), F.count_if(F.col("scaled") == 0).alias("at_zero"), F.count_if(F.col("scaled") == 1).alias("at_one"))


def vector_norms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").groupBy("label").agg(F.round(F.avg(N.norm2("embedding")), 6).alias("norm"), F.round(F.sum(F.sqrt(F.abs(F.get("embedding", F.lit(0)).cast("double")))), 5).alias("damped"))


def tsne_map(spark: SparkSession, d: str) -> DataFrame:
    """A place for each user on a map of event profiles rounded to whole numbers; users of one rounded profile share its place."""
    from ..session import ship_package

    ship_package(spark)
    rows = X.profiles(table(spark, d, "events"), "user_id", "event_type", KINDS).select("user_id", F.transform("profile", lambda x: F.round(x)).alias("profile"))
    groups = rows.groupBy("profile").agg(F.min("user_id").alias("least"))
    places = X.embed(groups, "least", "profile").withColumnRenamed("least", "_least")
    return rows.join(groups, "profile").join(places, F.col("least").eqNullSafe(F.col("_least"))).select("user_id", "x", "y")


def smiles_formula(spark: SparkSession, d: str) -> DataFrame:
    from ..session import ship_package

    ship_package(spark)
    known = ["CCO", "c1ccccc1", "CC(=O)O", "COc1cc(C=O)ccc1O", "CC(C)=CCCC(C)=CC=O", "C1CC1N", "[Na+].[Cl-]", "FC(F)(F)Cl", "O=S(=O)(O)O"]
    rows = table(spark, d, "part").select("p_partkey", F.get(F.array(*map(F.lit, known)), (F.col("p_partkey") % len(known)).cast("int")).alias("smiles"))
    return rows.groupBy("smiles").agg(F.count("*").alias("n")).select("smiles", "n", N.smiles_formula("smiles").alias("f")).select("smiles", "n", "f.formula", "f.mass")


def auc(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", "quality")
    rows = table(spark, d, "documents").select("doc_id", F.regexp_count("text", F.lit("!")).alias("score")).join(labels, "doc_id")
    return X.auc(rows.withColumn("score", -F.col("score")), "score", "quality").select(F.round("auc", 6).alias("auc"))


def array_edits(spark: SparkSession, d: str) -> DataFrame:
    """Arrays mapped, filtered, replaced, flattened, and freed of what stands inside a fuller member."""
    rows = table(spark, d, "part").select("p_partkey", F.split(F.lower("p_name"), "[ #_-]+").alias("words"), F.split("p_type", " ").alias("kinds"))
    both = F.concat("words", "kinds")
    fuller = F.filter(both, lambda m: ~F.exists(both, lambda o: (o != m) & F.contains(o, m)))
    return rows.select(
        "p_partkey",
        F.array_join(F.transform("kinds", lambda k: F.when(k == "STANDARD", "STD").otherwise(k)), "|").alias("replaced"),
        F.array_join(F.flatten(F.transform("words", lambda w: F.array(w, F.upper(w)))), "|").alias("doubled"),
        F.array_join(F.array_except("kinds", F.array(F.lit("STANDARD"))), "|").alias("removed"),
        F.coalesce(F.try_element_at("words", F.lit(9)), F.lit("")).alias("ninth"),
        F.array_join(fuller, "|").alias("fuller"),
        (F.size(F.array_except("words", both)) == 0).alias("subset"),
    )


def either_list(spark: SparkSession, d: str) -> DataFrame:
    """tags, or where there are none descriptors: an empty list counts as missing."""
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.array(F.lit("t"))).when(F.col("o_orderstatus") == "O", F.array().cast("array<string>")).alias("tags"), F.array("o_orderpriority").alias("descriptors"))
    chosen = F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.col("descriptors"))
    return rows.select(F.explode(chosen).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def cross_assertions(spark: SparkSession, d: str) -> DataFrame:
    """Every entity of a row with every descriptor of it."""
    rows = table(spark, d, "part").select("p_partkey", F.array("p_brand", F.concat(F.lit("size-"), F.col("p_size").cast("string"))).alias("entities"), F.split("p_type", " ").alias("descriptors"))
    pairs = rows.select("p_partkey", F.explode("entities").alias("entity"), "descriptors").select("entity", F.explode("descriptors").alias("descriptor"))
    return pairs.groupBy("entity", "descriptor").agg(F.count("*").alias("n"))


def dictionary_codes(spark: SparkSession, d: str) -> DataFrame:
    return X.dictionary_codes(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand").select("p_partkey", F.col("code").cast("int").alias("code"))


def cards(spark: SparkSession, d: str) -> DataFrame:
    """A flat card for each supplier: numbered texts without repeats, as JSON."""
    rows = table(spark, d, "lineitem").select("l_suppkey", F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("text")).distinct()
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("l_suppkey").orderBy("text")))
    entry = F.struct(F.concat(F.lit("Text "), F.col("n").cast("string")), "text")
    return numbered.groupBy("l_suppkey").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("card"))


def measured_values(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of value and source, each once, joined into two lists that stay aligned."""
    pairs = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_set(F.struct(F.col("l_linenumber").alias("v"), F.col("l_returnflag").alias("s")))).alias("p"))
    return pairs.select("l_partkey", F.array_join(F.transform("p", lambda x: x["v"].cast("string")), " || ").alias("v_list"), F.array_join(F.transform("p", lambda x: x["s"]), " || ").alias("s_list"))


def mode_label(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent label of each customer; ties go to the longer, then to the first by name."""
    counts = table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    order = Window.partitionBy("o_custkey").orderBy(F.desc("n"), F.desc(F.length("o_orderpriority")), "o_orderpriority")
    return counts.withColumn("r", F.row_number().over(order)).where(F.col("r") == 1).select("o_custkey", "o_orderpriority", "n")


def product_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.slug("p_name").alias("slug"), T.loose_key("p_name").alias("loose"), T.squash("p_name").alias("squashed"), T.plausible("p_name").alias("plausible"), T.ellipsis("p_name", 6).alias("short"))


def product_variants(spark: SparkSession, d: str) -> DataFrame:
    """The forms in which a product name may be looked up."""
    name = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") 10% in DPG extra"))
    return table(spark, d, "part").select("p_partkey", F.array_join(T.product_variants(name), "|").alias("variants"))


def release_counts(spark: SparkSession, d: str) -> DataFrame:
    """One struct of totals for a manifest, as JSON."""
    kinds = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return kinds.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("o_orderstatus", "n"))))).alias("counts"), F.sum("n").alias("total"))


_V = "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / n) AS v FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings))"
_EV = "WITH c AS (SELECT user_id, " + ", ".join(f"round(sqrt(count(*) FILTER (event_type = '{k}')::DOUBLE))::INTEGER AS {k}" for k in KINDS) + " FROM events GROUP BY user_id)"
# Formulas and masses of the nine structures, worked out by hand from the atomic masses.
_SMILES_SQL = """
WITH k(i, smiles, formula, mass) AS (VALUES
  (0, 'CCO', 'C2H6O', 2 * 12.011 + 6 * 1.008 + 15.999), (1, 'c1ccccc1', 'C6H6', 6 * 12.011 + 6 * 1.008), (2, 'CC(=O)O', 'C2H4O2', 2 * 12.011 + 4 * 1.008 + 2 * 15.999),
  (3, 'COc1cc(C=O)ccc1O', 'C8H8O3', 8 * 12.011 + 8 * 1.008 + 3 * 15.999), (4, 'CC(C)=CCCC(C)=CC=O', 'C10H16O', 10 * 12.011 + 16 * 1.008 + 15.999), (5, 'C1CC1N', 'C3H7N', 3 * 12.011 + 7 * 1.008 + 14.007),
  (6, '[Na+].[Cl-]', NULL, NULL), (7, 'FC(F)(F)Cl', 'CClF3', 12.011 + 35.45 + 3 * 18.998), (8, 'O=S(=O)(O)O', 'H2O4S', 2 * 1.008 + 4 * 15.999 + 32.06))
SELECT smiles, count(*) AS n, formula, round(mass::DOUBLE, 3) AS mass FROM part JOIN k ON i = p_partkey % 9 GROUP BY smiles, formula, mass
"""
PLANS: Plans = {
    "cosine_topk": (cosine_topk, f"{_V}, s AS (SELECT q.vec_id AS query_id, c.vec_id, round(list_dot_product(q.v, c.v), 9) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= 3"),
    "profile_groups": (profile_groups, f"{_EV} SELECT concat_ws(',', {', '.join(KINDS)}) AS profile, count(*) AS users, min(user_id) AS least FROM c GROUP BY 1"),
    "percentile_rescale": (percentile_rescale, "WITH b AS (SELECT event_type, quantile_cont(value, 0.03) AS lo, quantile_cont(value, 0.97) AS hi FROM events GROUP BY 1), s AS (SELECT event_type, greatest(0.0, least(1.0, (value - lo) / (hi - lo))) AS x FROM events JOIN b USING (event_type)) SELECT event_type, round(avg(x), 6) AS mean, count(*) FILTER (x = 0) AS at_zero, count(*) FILTER (x = 1) AS at_one FROM s GROUP BY 1"),
    "vector_norms": (vector_norms, "SELECT label, round(avg(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))), 6) AS norm, round(sum(sqrt(abs(embedding[1]::DOUBLE))), 5) AS damped FROM embeddings GROUP BY label"),
    "tsne_map": (tsne_map, None),
    "smiles_formula": (smiles_formula, _SMILES_SQL),
    "rank_auc": (auc, "WITH r AS (SELECT doc_id, -len(regexp_extract_all(text, '!')) AS score, quality FROM documents JOIN labels USING (doc_id)), b AS (SELECT score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM r GROUP BY score), w AS (SELECT pos, neg, pos * (coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + neg / 2) AS won FROM b) SELECT round((sum(won) / (sum(pos) * sum(neg)))::DOUBLE, 6) AS auc FROM w"),
    "array_edits": (array_edits, "WITH r AS (SELECT p_partkey, string_split_regex(lower(p_name), '[ #_-]+') AS w, string_split(p_type, ' ') AS k FROM part) SELECT p_partkey, array_to_string(list_transform(k, lambda x: CASE WHEN x = 'STANDARD' THEN 'STD' ELSE x END), '|') AS replaced, array_to_string(flatten(list_transform(w, lambda x: [x, upper(x)])), '|') AS doubled, array_to_string(list_distinct_ordered, '|') AS removed, coalesce(w[9], '') AS ninth, array_to_string(list_filter(w || k, lambda m: len(list_filter(w || k, lambda o: o <> m AND contains(o, m))) = 0), '|') AS fuller, true AS subset FROM (SELECT *, list_filter(k, lambda x: x <> 'STANDARD') AS list_distinct_ordered FROM r)"),
    "either_list": (either_list, "SELECT CASE WHEN o_orderstatus = 'F' THEN 't' ELSE o_orderpriority END AS term, count(*) AS n FROM orders GROUP BY 1"),
    "assertion_pairs": (cross_assertions, "WITH e AS (SELECT p_partkey, unnest([p_brand, 'size-' || p_size::VARCHAR]) AS entity, p_type FROM part), x AS (SELECT entity, unnest(string_split(p_type, ' ')) AS descriptor FROM e) SELECT entity, descriptor, count(*) AS n FROM x GROUP BY 1, 2"),
    "dictionary_codes": (dictionary_codes, "SELECT p_partkey, (dense_rank() OVER (ORDER BY p_brand) - 1)::INTEGER AS code FROM part"),
    "numbered_cards": (cards, "WITH r AS (SELECT DISTINCT l_suppkey, l_returnflag || ' ' || l_linestatus AS t FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY t) AS n FROM r) SELECT l_suppkey, '{' || string_agg('\"Text ' || n::VARCHAR || '\":\"' || t || '\"', ',' ORDER BY n) || '}' AS card FROM n GROUP BY 1"),
    "measured_values": (measured_values, "WITH p AS (SELECT DISTINCT l_partkey, l_linenumber AS v, l_returnflag AS s FROM lineitem) SELECT l_partkey, string_agg(v::VARCHAR, ' || ' ORDER BY v, s) AS v_list, string_agg(s, ' || ' ORDER BY v, s) AS s_list FROM p GROUP BY 1"),
    "mode_label": (mode_label, "WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, o_orderpriority, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, length(o_orderpriority) DESC, o_orderpriority) AS r FROM c) WHERE r = 1"),
    "product_names": (product_names, r"SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, regexp_replace(lower(p_name), '[^\p{L}\p{N}]', '', 'g') AS loose, translate(regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), 'loi', '101') AS squashed, len(regexp_extract_all(p_name, '[A-Za-z]')) >= 4 AS plausible, CASE WHEN length(p_name) > 6 THEN p_name[1:5] || '…' ELSE p_name END AS short FROM part"),
    "product_variants": (product_variants, "SELECT p_partkey, p_name || ' extra|' || p_name || '|' || p_brand AS variants FROM part"),
    "release_counts": (release_counts, "WITH k AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) SELECT '{' || string_agg('\"' || o_orderstatus || '\":' || n::VARCHAR, ',' ORDER BY o_orderstatus) || '}' AS counts, sum(n)::BIGINT AS total FROM k"),
}
