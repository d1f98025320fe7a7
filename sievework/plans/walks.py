"""Walks over growing folders and nested pages, guards that refuse, and clauses and lists of texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import identifiers as N
from ..functions import text as T
from ..operators import predicates as P
from ..operators import quality as Q
from ..session import ensure_checkpoint_dir, table
from ..sources import readers, sinks
from ..streaming.walk import walk
from .base import SENTENCES_SQL, Plans, sentences

PAGE = "Annotations array<struct<SourceName: string, Name: string, Data: array<struct<Value: struct<StringWithMarkup: array<struct<String: string>>>>>>>"
ALLOWED = ["Brand#1", "Brand#2", "list"]
HEAD, CAP = " (?:und|and|que|of|der|les|the) ", 300


def _folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints that goes when the application ends."""
    ensure_checkpoint_dir(spark)
    where = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/walk-{uuid.uuid4().hex}"
    path, files = sinks.files_of(spark, where)
    files.deleteOnExit(path(where))
    return where


def annotation_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of nested annotations, one for each part, written as JSON, read back and walked: only allowed sources."""
    strings = lambda x: F.struct(F.struct(F.transform(x, lambda w: F.struct(w.alias("String"))).alias("StringWithMarkup")).alias("Value"))
    one = F.struct(F.substring("p_brand", 1, 7).alias("SourceName"), F.col("p_name").alias("Name"), F.array(strings(F.split("p_name", " ")), strings(F.array("p_type"))).alias("Data"))
    bare = F.struct(F.lit("list").alias("SourceName"), F.col("p_type").alias("Name"), F.lit(None).alias("Data"))
    pages = table(spark, d, "part").select(F.from_json(F.to_json(F.struct(F.array(one, bare).alias("Annotations"))), PAGE).alias("p")).select("p.*")
    where = _folder(spark)
    sinks.write_json(pages, where)
    read = readers.json_lines(spark, where, StructType.fromDDL(PAGE))
    return readers.annotations(read, ALLOWED).groupBy("source", "name", "text").agg(F.count("*").alias("n"))


def clauses(spark: SparkSession, d: str) -> DataFrame:
    """Clauses that end in a head word, of all sentences of documents."""
    out = sentences(spark, d).select("doc_id", "pos", F.posexplode(P.odour_clause("s", HEAD)).alias("k", "c"))
    return out.select("doc_id", "pos", "k", F.md5("c").alias("digest"))


def contained(spark: SparkSession, d: str) -> DataFrame:
    """Whether the beginning of a text, in small letters, occurs in the text's JSON form."""
    docs = table(spark, d, "documents").where(F.col("text") != "")
    return docs.select("doc_id", T.in_json(F.to_json(F.struct("text")), F.lower(F.substring("text", 1, 80))).alias("held"))


def long_words(spark: SparkSession, d: str) -> DataFrame:
    """The long words of each text, each once, in the order in which they first come."""
    return table(spark, d, "documents").select("doc_id", F.md5(F.array_join(N.identifiers(T.words("text"), r"^\p{L}{10,}$"), ",")).alias("digest"))


def _refused(run: Callable[[], object]) -> bool:
    try:
        run()
    except (AnalysisException, ValueError) as e:
        if isinstance(e, AnalysisException) and e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return True
    return False


def guards(spark: SparkSession, d: str) -> DataFrame:
    """What each guard refused, and how many rows it then let through or left."""
    supplier, orders = table(spark, d, "supplier"), table(spark, d, "orders")
    where, dry = _folder(spark), _folder(spark)
    sinks.write_json(supplier, where)
    rows = [("existing target", _refused(lambda: sinks.write_json(supplier, where)), spark.read.json(where).count())]
    sinks.write_json(supplier.where("s_nationkey < 10"), where, force=True)
    rows += [("forced", False, spark.read.json(where).count())]
    path, files = sinks.files_of(spark, dry)
    seen = sinks.planned(supplier, dry).count()
    rows += [("dry run", not files.exists(path(dry)), seen)]
    sinks.planned(supplier, dry, write=True)
    rows += [("written plan", not files.exists(path(dry)), spark.read.parquet(dry).count())]
    for status in "FOP":
        own = orders.where(F.col("o_orderstatus") == status)
        rows += [(f"capped {status}", _refused(lambda own=own: P.read_capped(own, CAP)), own.count())]
    brands = table(spark, d, "part")
    for brand in ("Brand#13", "Brand#1x"):
        rows += [(f"asked {brand}", _refused(lambda brand=brand: Q.known_terms([brand], brands, "p_brand")), brands.where(F.col("p_brand") == brand).count())]
    for cap in (CAP, 1 << 40):
        walked = orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n")).withColumn("failed", F.when(F.col("n") > cap, F.array("year")).otherwise(F.array().cast("array<int>")))
        rows += [("partial walk" if cap == CAP else "whole walk", _refused(lambda walked=walked: Q.complete_only(walked, "failed")), walked.where(F.size("failed") > 0).count())]
    return spark.createDataFrame(rows, "guard string, refused boolean, n long")


def resumed(spark: SparkSession, d: str) -> DataFrame:
    """Customers' first orders by a walk that is stopped and taken up again when the other orders, and old ones once more, have come."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    source, target, checkpoint = (_folder(spark) for _ in range(3))
    early = orders.where("o_orderkey % 3 = 0")
    for more in (early, orders.where("o_orderkey % 3 <> 0").unionByName(early)):
        more.write.mode("append").parquet(source)
        walk(spark, source, orders.schema, "o_custkey", "o_orderkey", target, checkpoint).awaitTermination()
    told = spark.read.schema("key long, place long, fresh boolean").parquet(target)
    return told.groupBy(F.col("key").alias("o_custkey")).agg(F.min("place").alias("first_order"), F.count("*").alias("told"), F.count_if("fresh").alias("fresh"))


PLANS: Plans = {
    "annotation_pages": (annotation_pages, "WITH r AS (SELECT p_brand[1:7] AS source, p_name AS name, unnest(string_split(p_name, ' ')) AS text FROM part UNION ALL SELECT p_brand[1:7], p_name, p_type FROM part UNION ALL SELECT 'list', p_type, NULL FROM part) SELECT source, name, text, count(*) AS n FROM r WHERE source IN ('Brand#1', 'Brand#2', 'list') GROUP BY ALL"),
    "head_clauses": (clauses, rf"WITH {SENTENCES_SQL}, c AS (SELECT doc_id, pos, regexp_extract_all(s, '(?is)(.*?{HEAD})', 1) AS c FROM s), e AS (SELECT doc_id, pos, unnest(c) AS c, unnest(range(len(c)))::INTEGER AS k FROM c) SELECT doc_id, pos, k, md5(trim(regexp_replace(c, '(?is)^.*(\bwith\b|\bhas\b|\bhaving\b|;|\.\s)', ''))) AS digest FROM e"),
    "in_json_form": (contained, "SELECT doc_id, contains(text, lower(text[1:80])) AS held FROM documents WHERE text <> ''"),
    "long_words": (long_words, r"WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS l FROM documents), u AS (SELECT doc_id, unnest(l) AS w, unnest(range(len(l))) AS k FROM w), f AS (SELECT doc_id, w, min(k) AS k FROM u WHERE length(w) >= 10 GROUP BY 1, 2), j AS (SELECT doc_id, string_agg(w, ',' ORDER BY k) AS t FROM f GROUP BY 1) SELECT doc_id, md5(coalesce(t, '')) AS digest FROM documents LEFT JOIN j USING (doc_id)"),
    "guards": (guards, f"SELECT 'existing target' AS guard, true AS refused, count(*) AS n FROM supplier UNION ALL SELECT 'forced', false, count(*) FROM supplier WHERE s_nationkey < 10 UNION ALL SELECT 'dry run', true, count(*) FROM supplier UNION ALL SELECT 'written plan', false, count(*) FROM supplier UNION ALL SELECT 'capped ' || s, count(o_orderkey) > {CAP}, count(o_orderkey) FROM (VALUES ('F'), ('O'), ('P')) v(s) LEFT JOIN orders ON o_orderstatus = s GROUP BY s UNION ALL SELECT 'asked ' || b, count(p_partkey) = 0, count(p_partkey) FROM (VALUES ('Brand#13'), ('Brand#1x')) v(b) LEFT JOIN part ON p_brand = b GROUP BY b UNION ALL SELECT g, count(*) FILTER (k > c) > 0, count(*) FILTER (k > c) FROM (VALUES ('partial walk', {CAP}), ('whole walk', {1 << 40})) v(g, c), (SELECT year(o_orderdate) AS y, count(*) AS k FROM orders GROUP BY 1) GROUP BY g"),
    "resumed_walk": (resumed, "SELECT o_custkey, min(o_orderkey) AS first_order, 1 + coalesce(min(o_orderkey) < min(o_orderkey) FILTER (o_orderkey % 3 = 0), false)::BIGINT AS told, 1::BIGINT AS fresh FROM orders GROUP BY 1"),
}
