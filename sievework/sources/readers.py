"""Readers for the file forms that the data comes in."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stash

Schema = StructType | str


def whole_texts(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id (the file's stem), text: one row for each .txt file."""
    read = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    return read.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1).alias("doc_id"), F.col("value").alias("text"))


def json_lines(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Rows of a JSON Lines file; blank lines and header lines with a _comment are skipped; a malformed line fails."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    read = spark.read.schema(StructType([*fields.fields]).add("_comment", "string")).option("mode", "FAILFAST").json(path)
    return read.where(F.col("_comment").isNull()).drop("_comment")


def json_array(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def tsv(spark: SparkSession, path: str, schema: Schema, comment: str | None = None) -> DataFrame:
    """Tab-separated values with a header; lines that start with the comment sign are skipped."""
    read = spark.read.schema(schema).option("sep", "\t").option("header", True).option("mode", "FAILFAST").option("quote", '"')
    return (read.option("comment", comment) if comment else read).csv(path)


def annotations(pages: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """name, source, text of nested annotation pages: Annotations > Data > Value > StringWithMarkup, three levels exploded."""
    out = pages.select(F.explode_outer("Annotations").alias("a"))
    if sources is not None:
        out = out.where(F.col("a.SourceName").isin(sources))
    out = out.select("a", F.explode_outer("a.Data").alias("d")).select("a", F.explode_outer("d.Value.StringWithMarkup").alias("s"))
    return out.select(F.col("a.Name").alias("name"), F.col("a.SourceName").alias("source"), F.col("s.String").alias("text"))


def value_text(value: Column) -> Column:
    """The strings of a value joined, or its numbers and unit, or empty."""
    strings = F.trim(F.array_join(F.transform(value["StringWithMarkup"], lambda s: F.coalesce(s["String"], F.lit(""))), " "))
    numbers = F.concat(F.array_join(F.transform(value["Number"], lambda n: n.cast("string")), " "), F.coalesce(F.concat(F.lit(" "), value["Unit"]), F.lit("")))
    return F.coalesce(strings, numbers, F.lit(""))


def sections_below(spark: SparkSession, tree: DataFrame, headings: list[str]) -> DataFrame:
    """Rows of a section tree (id, parent, heading) that have one of the headings, at any depth, with their depth."""
    view = f"_section_tree_{uuid.uuid4().hex}"  # so that two calls in one session don't meet
    tree.createOrReplaceTempView(view)
    walked = spark.sql(f"WITH RECURSIVE w AS (SELECT id, heading, 0 AS depth FROM {view} WHERE parent IS NULL UNION ALL SELECT t.id, t.heading, w.depth + 1 FROM {view} t JOIN w ON t.parent = w.id) SELECT * FROM w")
    return walked.where(F.col("heading").isin(headings))


def search_response(xml: Column | str) -> tuple[Column, Column]:
    """total and ids of an XML search response; the namespace prefixes are dropped first."""
    plain = F.regexp_replace(F.col(xml) if isinstance(xml, str) else xml, r"(</?)\w+:", "$1")
    return F.try_to_number(F.xpath_string(plain, F.lit("//biblio-search/@total-result-count")), F.lit("999999999")).cast("long"), F.array_distinct(F.xpath(plain, F.lit("//document-id/doc-number/text()")))


def split_ranges(rows: DataFrame, unit: str, low: int, high: int, cap: int) -> DataFrame:
    """lo, hi, n, status: windows of units that hold less than the cap, found by halving those that don't.

    A window of one unit at the cap has status failed, an empty one empty; nothing is dropped. Counts come from running
    totals, so a level is two small joins; the number of levels is that of halvings of the range.
    """
    spark = rows.sparkSession
    per = rows.groupBy(F.col(unit).cast("int").alias("u")).agg(F.count("*").alias("k"))
    axis = spark.range(low, high + 1).select(F.col("id").cast("int").alias("u")).join(per, "u", "left")
    total = axis.select("u", F.coalesce(F.sum("k").over(Window.orderBy("u").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("t"))
    total = stash(total)
    now = spark.range(1).select(F.lit(low).alias("lo"), F.lit(high).alias("hi"))
    done = None
    for _ in range(max(1, (high - low).bit_length() + 1)):
        counted = now.join(total.select(F.col("u").alias("lo"), F.col("t").alias("a")), "lo").join(total.select(F.col("u").alias("hi"), F.col("t").alias("b")), "hi").select("lo", "hi", (F.col("b") - F.col("a")).alias("n"))
        over = (F.col("n") >= cap) & (F.col("hi") - F.col("lo") > 1)
        status = F.when(F.col("n") == 0, "empty").when(F.col("n") >= cap, "failed").otherwise("ok")
        fits = counted.where(~over).withColumn("status", status)
        done = fits if done is None else done.unionByName(fits)
        middle = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
        now = counted.where(over).select(F.explode(F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))).alias("w")).select("w.lo", "w.hi")
    return done


def least_id(answers: DataFrame, asked: str, key: str, identity: str) -> DataFrame:
    """Of a batched lookup's answers those that are for the very key asked, and of several the least id."""
    return answers.where(F.col(asked) == F.col(key)).groupBy(asked).agg(F.min(identity).alias(identity))


def split_prefixes(rows: DataFrame, text: str, cap: int, longest: int) -> DataFrame:
    """prefix, n, status: prefixes that fewer than the cap of rows have, made longer where there are more.

    At the longest prefix a window at the cap has status failed. A value shorter than a prefix is a window of its own.
    Each row is counted in one prefix: the shortest of its prefixes that is below the cap.
    """
    counts = rows.where(F.col(text).isNotNull()).groupBy(F.substring(text, 1, longest).alias("p")).agg(F.count("*").alias("n"))
    counts = stash(counts)
    left, done = counts, None
    for size in range(1, longest + 1):
        level = left.groupBy(F.substring("p", 1, size).alias("prefix")).agg(F.sum("n").alias("n"))
        over = (F.col("n") >= cap) & (F.length("prefix") == size)
        last = F.lit(size == longest)
        fits = level.where(~over | last).withColumn("status", F.when(F.col("n") >= cap, "failed").otherwise("ok"))
        done = fits if done is None else done.unionByName(fits)
        if size < longest:
            left = left.withColumn("prefix", F.substring("p", 1, size)).join(level.where(over).select("prefix"), "prefix", "left_semi").drop("prefix")
    return done


def split_years(rows: DataFrame, prefix: str, year: str, cap: int, first: int, wide: int = 3) -> DataFrame:
    """prefix, from_year, to_year, n, status: a prefix at the cap is cut into windows of `wide` years, such a window into years.

    Both years are null for a prefix that is below the cap as a whole. A single year at the cap has status failed; nothing
    is dropped. Rows are counted by prefix and year first, so what the windows order is a few rows for each prefix.
    """
    per = rows.groupBy(F.col(prefix).alias("prefix"), F.col(year).alias("y")).agg(F.count("*").alias("k"))
    block = F.col("y") - F.pmod(F.col("y") - first, F.lit(wide))
    per = per.withColumn("b", block).withColumns({"t": F.sum("k").over(Window.partitionBy("prefix")), "w": F.sum("k").over(Window.partitionBy("prefix", "b"))})
    start = F.when(F.col("t") < cap, F.lit(None)).when(F.col("w") < cap, F.col("b")).otherwise(F.col("y"))
    stop = F.when(F.col("t") < cap, F.lit(None)).when(F.col("w") < cap, F.col("b") + (wide - 1)).otherwise(F.col("y"))
    out = per.groupBy("prefix", start.alias("from_year"), stop.alias("to_year")).agg(F.sum("k").alias("n"))
    return out.withColumn("status", F.when(F.col("n") < cap, "ok").otherwise("failed"))
