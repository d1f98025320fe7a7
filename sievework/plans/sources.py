"""Sources and event time over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as N
from ..functions import text as T
from ..sources import readers as R
from ..streaming import incremental as I
from ..session import table
from .base import Plans


def range_split(spark: SparkSession, d: str) -> DataFrame:
    return R.split_ranges(table(spark, d, "orders").select((F.col("o_custkey") % 512).alias("u")), "u", 0, 512, 300)


def prefix_split(spark: SparkSession, d: str) -> DataFrame:
    return R.split_prefixes(table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("k")), "k", 500, 3)


def answers(spark: SparkSession, d: str) -> DataFrame:
    """Classes of service answers: numbers of orders stand for status codes."""
    status = F.element_at(F.array(*map(F.lit, (200, 404, 403, 403, 500))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    body = F.when(F.col("o_orderkey") % 5 == 2, "Quota exceeded")
    return table(spark, d, "orders").groupBy(N.response_class(status, body).alias("answer")).agg(F.count("*").alias("n"))


def date_windows(spark: SparkSession, d: str) -> DataFrame:
    """Three-year windows and whether they hit a cap."""
    year = F.year("o_orderdate")
    out = table(spark, d, "orders").groupBy((year - year % 3).alias("from_year")).agg(F.count("*").alias("n"))
    return out.select("from_year", "n", (F.col("n") >= 6000).alias("capped"))


def tumbling(spark: SparkSession, d: str) -> DataFrame:
    out = I.tumbling(table(spark, d, "events"), "ts", "1 hour", "event_type")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def sessions(spark: SparkSession, d: str) -> DataFrame:
    out = I.sessions(table(spark, d, "events"), "ts", "30 minutes", "user_id")
    return out.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def section_tree(spark: SparkSession, d: str) -> DataFrame:
    """Regions, nations and suppliers as a tree of sections; those with a heading that is asked for."""
    region = table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("heading"))
    nation = table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"), F.col("n_name").alias("heading"))
    supplier = table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("parent"), F.substring("s_name", 1, 8).alias("heading"))
    out = R.sections_below(spark, region.unionByName(nation).unionByName(supplier), ["ASIA", "EUROPE", "Supplier"])
    return out.groupBy("heading", "depth").agg(F.count("*").alias("n"))


def hosts(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue of distinct headings with a filter."""
    return table(spark, d, "pages").select(F.regexp_extract("url", r"^[a-z]+://([^/:]+)", 1).alias("host")).distinct().where(F.contains("host", F.lit("."))).orderBy("host")


def license_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line-wise sentences of documents that mention a licence or a copyright."""
    lines = table(spark, d, "documents").select("doc_id", F.explode(T.line_sentences("text")).alias("s"))
    return lines.where(F.rlike("s", F.lit("(?i)licen[cs]e|copyright"))).select("doc_id", F.md5("s").alias("digest"))


def headers(spark: SparkSession, d: str) -> DataFrame:
    header = F.concat(F.lit("search=green:"), (F.col("o_orderkey") % 30 + 1).cast("string"))
    return table(spark, d, "orders").select(F.round(N.gap_seconds(header), 6).alias("gap")).groupBy("gap").agg(F.count("*").alias("n"))


def id_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Of the lookup's answers those for the key asked, the least id each."""
    asked = table(spark, d, "lineitem").select(F.col("l_partkey").alias("asked"), F.when(F.col("l_linenumber") > 3, F.col("l_partkey") + 1).otherwise(F.col("l_partkey")).alias("key"), F.col("l_suppkey").alias("cid"))
    return R.least_id(asked, "asked", "key", "cid")


def incremental(spark: SparkSession, d: str) -> DataFrame:
    """What a second ingestion of the later half would add to the table of the first."""
    events = table(spark, d, "events")
    held = events.where(F.col("event_id") % 4 != 0).select("event_id")
    return I.todo(events, held, "event_id").groupBy("event_type").agg(F.count("*").alias("n"))


PLANS: Plans = {
    "range_split": (range_split, "WITH RECURSIVE u AS (SELECT o_custkey % 512 AS u FROM orders), w(lo, hi) AS (SELECT 0, 512 UNION ALL SELECT CASE WHEN k = 0 THEN lo ELSE lo + (hi - lo) // 2 END, CASE WHEN k = 0 THEN lo + (hi - lo) // 2 ELSE hi END FROM w, (VALUES (0), (1)) t(k) WHERE hi - lo > 1 AND (SELECT count(*) FROM u WHERE u.u >= lo AND u.u < hi) >= 300), c AS (SELECT lo, hi, (SELECT count(*) FROM u WHERE u.u >= lo AND u.u < hi) AS n FROM w) SELECT lo, hi, n, CASE WHEN n = 0 THEN 'empty' WHEN n >= 300 THEN 'failed' ELSE 'ok' END AS status FROM c WHERE NOT (n >= 300 AND hi - lo > 1)"),
    "prefix_split": (prefix_split, "WITH k AS (SELECT o_custkey::VARCHAR AS k FROM orders), a AS (SELECT k[1:1] AS p, count(*) AS n FROM k GROUP BY 1), b AS (SELECT k[1:2] AS p, count(*) AS n FROM k WHERE k[1:1] IN (SELECT p FROM a WHERE n >= 500) GROUP BY 1), c AS (SELECT k[1:3] AS p, count(*) AS n FROM k WHERE k[1:2] IN (SELECT p FROM b WHERE n >= 500 AND length(p) = 2) GROUP BY 1) SELECT p AS prefix, n, 'ok' AS status FROM a WHERE n < 500 UNION ALL SELECT p, n, CASE WHEN n >= 500 THEN 'failed' ELSE 'ok' END FROM b WHERE n < 500 OR length(p) < 2 UNION ALL SELECT p, n, CASE WHEN n >= 500 THEN 'failed' ELSE 'ok' END FROM c"),
    "answer_classes": (answers, "SELECT CASE o_orderkey % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'gone' WHEN 2 THEN 'quota' WHEN 3 THEN 'forbidden' ELSE 'retry' END AS answer, count(*) AS n FROM orders GROUP BY 1"),
    "date_windows": (date_windows, "SELECT (year(o_orderdate) - year(o_orderdate) % 3)::INTEGER AS from_year, count(*) AS n, count(*) >= 6000 AS capped FROM orders GROUP BY 1"),
    "event_tumbling": (tumbling, "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"),
    "event_sessions": (sessions, "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g), n AS (SELECT user_id, s, count(*) AS n FROM s GROUP BY 1, 2) SELECT user_id, count(*) AS sessions, max(n) AS longest FROM n GROUP BY 1"),
    "section_tree": (section_tree, "WITH t AS (SELECT r_name AS heading, 0 AS depth FROM region UNION ALL SELECT n_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT s_name[1:8], 2 FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT heading, depth, count(*) AS n FROM t WHERE heading IN ('ASIA', 'EUROPE', 'Supplier') GROUP BY 1, 2"),
    "heading_catalogue": (hosts, "SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/:]+)', 1) AS host FROM pages WHERE contains(regexp_extract(url, '^[a-z]+://([^/:]+)', 1), '.')"),
    "line_sentences": (license_lines, r"WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents), p AS (SELECT doc_id, trim(unnest(string_split(regexp_replace(l, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)))) AS s FROM l) SELECT doc_id, md5(s) AS digest FROM p WHERE s <> '' AND regexp_matches(s, '(?i)licen[cs]e|copyright')"),
    "header_gaps": (headers, "SELECT round(60.0::DOUBLE / (o_orderkey % 30 + 1), 6) AS gap, count(*) AS n FROM orders GROUP BY 1"),
    "id_lookup": (id_lookup, "SELECT l_partkey AS asked, min(l_suppkey) AS cid FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1"),
    "incremental_todo": (incremental, "SELECT event_type, count(*) AS n FROM events WHERE event_id % 4 = 0 GROUP BY 1"),
}
