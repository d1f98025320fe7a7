"""Samples, evaluations, identities and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import identifiers as N
from ..functions import text as T
from ..operators import evaluation as E
from ..operators import quality as Q
from ..operators.rules import DATA_RULES, first_reason
from ..operators.order import running
from ..session import table
from .base import SENTENCES_SQL, Plans, sentences, sql_reason


def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return E.sample(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", "seed-7:", 40)


def two_tier_sample(spark: SparkSession, d: str) -> DataFrame:
    """Finished orders first."""
    return E.sample(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "seed-3:", 50, F.col("o_orderstatus") == "P")


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return E.stratified(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", "seed-9:", 15)


def era_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", N.era("o_orderkey", (1000, 5000, 10000)).alias("era"))
    return E.stratified(rows, "era", "o_orderkey", "era:", 12)


def first_examples(spark: SparkSession, d: str) -> DataFrame:
    judged = sentences(spark, d).withColumn("reason", first_reason("s", DATA_RULES))
    w = Window.partitionBy("reason").orderBy("doc_id", "pos")
    return judged.withColumn("n", F.row_number().over(w)).where(F.col("n") <= 3).select("reason", "n", "doc_id", "pos")


def earliest_k(spark: SparkSession, d: str) -> DataFrame:
    """Of each customer the three earliest finished orders and the earliest open one that aren't held."""
    held = table(spark, d, "orders").where(F.col("o_orderkey") % 11 == 0).select("o_orderkey")
    w = Window.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, d, "orders").join(held, "o_orderkey", "left_anti").where(F.col("o_orderstatus").isin("F", "O")).withColumn("n", F.row_number().over(w))
    return rows.where(F.col("n") <= F.when(F.col("o_orderstatus") == "F", 3).otherwise(1)).select("o_custkey", "o_orderkey", "o_orderstatus", "n")


def repeat_suppression(spark: SparkSession, d: str) -> DataFrame:
    """Lines that name a part that the order has named before are suppressed."""
    w = Window.partitionBy("l_orderkey", "l_partkey").orderBy("l_linenumber", "l_extendedprice", "l_suppkey")
    return table(spark, d, "lineitem").withColumn("n", F.row_number().over(w)).groupBy((F.col("n") > 1).alias("suppressed")).agg(F.count("*").alias("rows"))


def dup_suffix(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.concat_ws(":", "l_orderkey", "l_linenumber").alias("id"), "l_extendedprice", "l_partkey", "l_suppkey")
    return Q.with_suffixes(rows, "id", [F.col("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey")]).select("id", "l_partkey")


def evidence_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", N.evidence_id(F.lit("chat"), "conv_id", "role", "text").alias("id"))
    return Q.with_suffixes(rows, "id", [F.col("conv_id"), F.col("turn")])


def nulls_last(spark: SparkSession, d: str) -> DataFrame:
    """Rank with unlabelled documents last."""
    rows = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 10).alias("k")).join(table(spark, d, "labels"), "doc_id", "left")
    return running(rows, ["k"], [F.col("quality").asc_nulls_last(), F.col("doc_id")]).select("doc_id", F.col("place").alias("rank"))


def predicted(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, got, want, stratum: a rule's prediction of quality beside the label."""
    docs = table(spark, d, "documents").select("doc_id", "lang", (~F.rlike("text", F.lit(r"!!|\||[*#&$%]{3}"))).alias("got"))
    return docs.join(table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("want")), "doc_id")


def precision_recall(spark: SparkSession, d: str) -> DataFrame:
    return E.precision_recall(predicted(spark, d), F.col("got"), F.col("want"))


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return E.confusion(predicted(spark, d), "want", "got")


def reweighted(spark: SparkSession, d: str) -> DataFrame:
    every = table(spark, d, "documents").select("doc_id", F.rlike("text", F.lit(r"!!|\||[*#&$%]{3}")).alias("stratum"))
    drawn = E.stratified(every, "stratum", "doc_id", "r1:", 100)
    weights = E.stratum_weights(every, drawn, "stratum")
    rows = drawn.join(F.broadcast(weights), "stratum").join(table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("want")), "doc_id")
    return E.precision_recall(rows, ~F.col("stratum"), F.col("want"), F.col("weight"))


def yield_projection(spark: SparkSession, d: str) -> DataFrame:
    judged = sentences(spark, d).withColumn("kept", (first_reason("s", DATA_RULES) == "kept").cast("int"))
    per = judged.groupBy("lang").agg(F.countDistinct("doc_id").alias("docs"), F.sum("kept").alias("kept"))
    whole = judged.agg(F.countDistinct("doc_id").alias("all_docs"), F.sum("kept").alias("all_kept")).withColumn("one", F.lit(1))
    out = per.withColumn("one", F.lit(1)).join(F.broadcast(whole), "one")
    rate = F.col("kept") / F.col("docs")
    return out.select("lang", "docs", "kept", F.round(rate, 6).alias("per_doc"), F.round(E.ratio(rate, F.col("all_kept") / F.col("all_docs")), 6).alias("to_base"), F.round(rate * 10000, 3).alias("per_10000"))


def agreement(spark: SparkSession, d: str) -> DataFrame:
    """Running agreement of prediction and label in order of document."""
    right = F.when(F.col("got") == F.col("want"), 1).otherwise(0)
    out = running(predicted(spark, d), ["lang"], [F.col("doc_id")], {"right": right})
    return out.select("doc_id", F.round(F.col("right") / F.col("place"), 6).alias("agreement"))


def verbatim_violations(spark: SparkSession, d: str) -> DataFrame:
    """Spans (all sentences) that aren't in the text they were taken from; here some of every seventh text were changed on purpose."""
    docs = table(spark, d, "documents").select("doc_id", T.norm_text("text").alias("t"))
    spans = F.transform(T.sentences("t"), lambda s, i: F.struct(i.alias("pos"), F.when((F.col("doc_id") % 7 == 0) & (i % 3 == 0), F.concat(s, F.lit("~~"))).otherwise(s).alias("s")))
    return docs.select("doc_id", F.explode(F.transform(F.filter(spans, lambda x: ~T.verbatim(F.col("t"), x["s"])), lambda x: x["pos"])).alias("pos"))


def domain_violations(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    bad = F.concat_ws(";", F.when(F.col("l_quantity") > 49, "quantity"), F.when(F.col("l_discount") > 0.09, "discount"), F.when(~F.col("l_returnflag").isin("A", "N", "R"), "flag"))
    return rows.select(bad.alias("problems")).where(F.col("problems") != "").groupBy("problems").agg(F.count("*").alias("n"))


def reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Two plans that must agree: orders per customer counted directly, and from the exported rows."""
    direct = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    export = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey").agg(F.count("*").alias("m"))
    both = direct.join(export, F.col("o_custkey") == F.col("c_custkey"), "full")
    return both.agg(F.count("*").alias("customers"), F.count_if(~F.col("n").eqNullSafe(F.col("m"))).alias("differ"), F.sum("n").alias("orders"))


def key_check(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    return rows.agg(F.count("*").alias("rows"), F.countDistinct("l_orderkey", "l_linenumber").alias("keys"), F.count_if(F.col("l_tax").isNull() | F.isnan("l_tax")).alias("not_numbers"))


def collapse_check(spark: SparkSession, d: str) -> DataFrame:
    """A mapping of ids must not merge them."""
    ids = table(spark, d, "customer").select("c_name", N.canonical("c_name").alias("f"), F.substring("c_name", 1, 14).alias("g"))
    return ids.agg(F.countDistinct("c_name").alias("ids"), F.countDistinct("f").alias("mapped"), F.countDistinct("g").alias("cut"))


def trust(spark: SparkSession, d: str) -> DataFrame:
    tier = F.when(F.col("o_orderkey") % 4 == 0, "verbatim").when(F.col("o_orderkey") % 4 == 1, "ocr").when(F.col("o_orderkey") % 4 == 2, "stereo_dropped")
    check = F.when(F.col("o_orderkey") % 9 == 0, "agree").when(F.col("o_orderkey") % 9 == 1, "different").otherwise("unmatched")
    return table(spark, d, "orders").select(Q.trust_class(tier, F.col("o_orderstatus") == "F", check).alias("trust")).groupBy("trust").agg(F.count("*").alias("n"))


def tier_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Words resolve verbatim, repaired, or without their ending; overrides win, ambiguous parts are refused."""
    words = table(spark, d, "documents").where(F.col("lang") == "en").select(F.explode(T.words("text")).alias("name")).where(F.rlike("name", F.lit("^[a-z]{6,}$"))).distinct()
    base = words.where(F.length("name") % 3 == 0)
    resolver = base.select(F.col("name").alias("form"), F.md5("name").alias("identity"), F.when(F.ascii(F.substring("name", -1, 1)) % 2 == 0, 1).otherwise(2).alias("parts"))
    overrides = words.where(F.endswith("name", F.lit("tion"))).select("name", F.lit("hand").alias("identity"))
    steps = [("verbatim", F.col("name")), ("repaired", F.replace("name", F.lit("th"), F.lit("st"))), ("cut", F.substring("name", 1, 6))]
    return Q.tiers(words, "name", resolver, steps, overrides).groupBy("tier").agg(F.count("*").alias("n"), F.countDistinct("identity").alias("identities"))


def checksums(spark: SparkSession, d: str) -> DataFrame:
    number = F.lpad((F.col("p_partkey") * 7919 % 1000000).cast("string"), 6, "0")
    ec = F.concat(F.substring(number, 1, 3), F.lit("-"), F.substring(number, 4, 3), F.lit("-"), (F.col("p_partkey") % 10).cast("string"))
    return table(spark, d, "part").select("p_partkey", N.registry_number_ok(ec).alias("ok"))


def publication_ids(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("US20"), F.lpad((F.col("o_orderkey") % 25).cast("string"), 2, "0"), (F.col("o_orderkey") % 99999).cast("string"), F.lit("A1"))).otherwise(F.concat(F.lit("US-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit("B2")))
    key = N.publication_key(raw)
    return table(spark, d, "orders").select("o_orderkey", N.padded_application(raw).alias("padded"), N.canonical(raw).alias("canonical"), key["kind"].alias("kind"), key["number"].alias("number"))


_J = rf"WITH {SENTENCES_SQL}, j AS (SELECT *, {sql_reason('s')} AS reason FROM s)"
_PR = "SELECT round(tp, 6) AS tp, round(fp, 6) AS fp, round(fn, 6) AS fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM t)"
_G = "WITH g AS (SELECT doc_id, lang, NOT regexp_matches(text, '!!|\\||[*#&$%]{3}') AS got, quality = 1 AS want FROM documents JOIN labels USING (doc_id))"
_EC = "lpad((p_partkey * 7919 % 1000000)::VARCHAR, 6, '0')"
_RAW = "CASE WHEN o_orderkey % 3 = 0 THEN 'US20' || lpad((o_orderkey % 25)::VARCHAR, 2, '0') || (o_orderkey % 99999)::VARCHAR || 'A1' ELSE 'US-' || lpad(o_orderkey::VARCHAR, 9, '0') || 'B2' END"
PLANS: Plans = {
    "hash_sample": (hash_sample, "SELECT doc_id, lang FROM documents ORDER BY md5('seed-7:' || doc_id::VARCHAR), doc_id LIMIT 40"),
    "two_tier_sample": (two_tier_sample, "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderstatus = 'P' DESC, md5('seed-3:' || o_orderkey::VARCHAR), o_orderkey LIMIT 50"),
    "stratified_hash_sample": (stratified_sample, "SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('seed-9:' || doc_id::VARCHAR), doc_id) AS n FROM documents) WHERE n <= 15"),
    "era_sample": (era_sample, "WITH e AS (SELECT o_orderkey, ((o_orderkey >= 1000)::INTEGER + (o_orderkey >= 5000)::INTEGER + (o_orderkey >= 10000)::INTEGER) AS era FROM orders) SELECT o_orderkey, era FROM (SELECT *, row_number() OVER (PARTITION BY era ORDER BY md5('era:' || o_orderkey::VARCHAR), o_orderkey) AS n FROM e) WHERE n <= 12"),
    "first_n_examples": (first_examples, f"{_J} SELECT reason, n::INTEGER AS n, doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY doc_id, pos) AS n FROM j) WHERE n <= 3"),
    "earliest_k": (earliest_k, "SELECT o_custkey, o_orderkey, o_orderstatus, n::INTEGER AS n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS n FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderstatus IN ('F', 'O')) WHERE n <= CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END"),
    "repeat_suppression": (repeat_suppression, 'SELECT n > 1 AS suppressed, count(*) AS "rows" FROM (SELECT row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber) AS n FROM lineitem) GROUP BY 1'),
    "dup_id_suffix": (dup_suffix, "SELECT CASE WHEN n > 1 THEN id || '-' || n::VARCHAR ELSE id END AS id, l_partkey FROM (SELECT id, l_partkey, row_number() OVER (PARTITION BY id ORDER BY l_extendedprice, l_partkey, l_suppkey) AS n FROM (SELECT *, l_orderkey::VARCHAR || ':' || l_linenumber::VARCHAR AS id FROM lineitem))"),
    "evidence_ids": (evidence_ids, r"WITH e AS (SELECT conv_id, turn, sha1('chat|' || conv_id::VARCHAR || '|' || role || '|' || trim(regexp_replace(text, '\s+', ' ', 'g')))[1:12] AS id FROM conversations) SELECT conv_id, turn, CASE WHEN n > 1 THEN id || '-' || n::VARCHAR ELSE id END AS id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY conv_id, turn) AS n FROM e)"),
    "nulls_last_rank": (nulls_last, "SELECT doc_id, row_number() OVER (PARTITION BY doc_id % 10 ORDER BY quality ASC NULLS LAST, doc_id)::INTEGER AS rank FROM documents LEFT JOIN labels USING (doc_id)"),
    "precision_recall_f1": (precision_recall, f"{_G}, t AS (SELECT count(*) FILTER (got AND want)::DOUBLE AS tp, count(*) FILTER (got AND NOT want)::DOUBLE AS fp, count(*) FILTER (NOT got AND want)::DOUBLE AS fn FROM g) {_PR}"),
    "confusion_matrix": (confusion, f"{_G} SELECT want, got, count(*) AS n FROM g GROUP BY 1, 2"),
    "stratum_reweighted_pr": (reweighted, f"WITH e AS (SELECT doc_id, regexp_matches(text, '!!|\\||[*#&$%]{{3}}') AS stratum FROM documents), d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('r1:' || doc_id::VARCHAR), doc_id) AS n FROM e) WHERE n <= 100), w AS (SELECT stratum, (SELECT count(*) FROM e WHERE e.stratum = d.stratum)::DOUBLE / count(*) AS weight FROM d GROUP BY stratum), x AS (SELECT NOT stratum AS got, quality = 1 AS want, weight FROM d JOIN w USING (stratum) JOIN labels USING (doc_id)), t AS (SELECT coalesce(sum(weight) FILTER (got AND want), 0) AS tp, coalesce(sum(weight) FILTER (got AND NOT want), 0) AS fp, coalesce(sum(weight) FILTER (NOT got AND want), 0) AS fn FROM x) {_PR}"),
    "yield_projection": (yield_projection, f"{_J}, p AS (SELECT lang, count(DISTINCT doc_id) AS docs, count(*) FILTER (reason = 'kept') AS kept FROM j GROUP BY lang), w AS (SELECT sum(docs) AS ad, sum(kept) AS ak FROM p) SELECT lang, docs, kept, round(kept::DOUBLE / docs, 6) AS per_doc, round((kept::DOUBLE / docs) / (ak::DOUBLE / ad::DOUBLE), 6) AS to_base, round(kept::DOUBLE / docs * 10000, 3) AS per_10000 FROM p, w"),
    "running_agreement": (agreement, f"{_G} SELECT doc_id, round(avg((got = want)::INTEGER::DOUBLE) OVER (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING), 6) AS agreement FROM g"),
    "verbatim_violations": (verbatim_violations, rf"WITH {SENTENCES_SQL} SELECT n.doc_id, s.pos FROM n JOIN s USING (doc_id) WHERE NOT contains(n.t, CASE WHEN n.doc_id % 7 = 0 AND s.pos % 3 = 0 THEN s.s || '~~' ELSE s.s END)"),
    "domain_violations": (domain_violations, "SELECT problems, count(*) AS n FROM (SELECT concat_ws(';', CASE WHEN l_quantity > 49 THEN 'quantity' END, CASE WHEN l_discount > 0.09 THEN 'discount' END, CASE WHEN l_returnflag NOT IN ('A', 'N', 'R') THEN 'flag' END) AS problems FROM lineitem) WHERE problems <> '' GROUP BY 1"),
    "reconcile_export": (reconcile, "WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, count(*) AS m FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1) SELECT count(*) AS customers, count(*) FILTER (n IS DISTINCT FROM m) AS differ, sum(n)::BIGINT AS orders FROM a FULL JOIN b USING (k)"),
    "key_and_numeric_check": (key_check, 'SELECT count(*) AS "rows", count(DISTINCT (l_orderkey, l_linenumber)) AS keys, count(*) FILTER (l_tax IS NULL OR isnan(l_tax)) AS not_numbers FROM lineitem'),
    "collapse_check": (collapse_check, "SELECT count(DISTINCT c_name) AS ids, count(DISTINCT regexp_replace(replace(c_name, '-', ''), '^US0*', 'US')) AS mapped, count(DISTINCT c_name[1:14]) AS cut FROM customer"),
    "trust_class": (trust, "WITH o AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'verbatim' WHEN 1 THEN 'ocr' WHEN 2 THEN 'stereo_dropped' END AS tier, CASE o_orderkey % 9 WHEN 0 THEN 'agree' WHEN 1 THEN 'different' ELSE 'unmatched' END AS c, o_orderstatus = 'F' AS w FROM orders) SELECT CASE WHEN tier IS NULL THEN 'none' WHEN c = 'different' THEN 'disputed' WHEN tier = 'verbatim' THEN 'verbatim' WHEN c = 'agree' THEN 'check' WHEN w THEN 'repaired+witness' WHEN tier = 'stereo_dropped' THEN 'flat' ELSE 'provisional' END AS trust, count(*) AS n FROM o GROUP BY 1"),
    "tier_cascade": (tier_cascade, r"WITH w AS (SELECT DISTINCT name FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS name FROM documents WHERE lang = 'en') WHERE regexp_matches(name, '^[a-z]{6,}$')), r AS (SELECT name AS form, md5(name) AS identity FROM w WHERE length(name) % 3 = 0 AND ascii(right(name, 1)) % 2 = 0), x AS (SELECT w.name, CASE WHEN ends_with(w.name, 'tion') THEN 'override' WHEN a.form IS NOT NULL THEN 'verbatim' WHEN b.form IS NOT NULL THEN 'repaired' WHEN c.form IS NOT NULL THEN 'cut' ELSE 'unresolved' END AS tier, CASE WHEN ends_with(w.name, 'tion') THEN 'hand' ELSE coalesce(a.identity, b.identity, c.identity) END AS identity FROM w LEFT JOIN r a ON a.form = w.name LEFT JOIN r b ON b.form = replace(w.name, 'th', 'st') LEFT JOIN r c ON c.form = w.name[1:6]) SELECT tier, count(*) AS n, count(DISTINCT identity) AS identities FROM x GROUP BY tier"),
    "registry_checksum": (checksums, f"WITH d AS (SELECT p_partkey, {_EC} AS n, p_partkey % 10 AS c FROM part) SELECT p_partkey, ({' + '.join(f'{i} * n[{i}]::INTEGER' for i in range(1, 7))}) % 11 = c AS ok FROM d"),
    "publication_ids": (publication_ids, rf"WITH r AS (SELECT o_orderkey, {_RAW} AS r FROM orders) SELECT o_orderkey, CASE WHEN regexp_matches(r, '^US(19|20)[0-9][0-9][0-9]{{1,7}}A[0-9]$') THEN r[1:6] || lpad(regexp_extract(r, '^US[0-9]{{4}}([0-9]+)A[0-9]$', 1), 7, '0') || r[-2:] ELSE r END AS padded, regexp_replace(replace(r, '-', ''), '^US0*', 'US') AS canonical, CASE WHEN regexp_matches(r, 'A[0-9]$') THEN 'application' ELSE 'grant' END AS kind, regexp_extract(replace(r, '-', ''), '^US(RE|D|PP)?0*([0-9]+)', 2)::BIGINT AS number FROM r"),
}
