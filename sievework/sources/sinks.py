"""Writers: refusing, versioned, atomic; and the manifest of what was written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_field


def write_json(df: DataFrame, path: str, force: bool = False) -> None:
    """JSON Lines; an existing target is refused unless forced."""
    df.write.mode("overwrite" if force else "errorifexists").json(path)


def write_tsv(df: DataFrame, path: str, order: list[str], force: bool = False) -> None:
    """Tab-separated files with headers that follow one another in order; a small table is one file. Fields are cleaned, so none holds a tab or line end."""
    plain = df.select(*(clean_field(c).alias(c) for c in df.columns)) if df.columns else df
    plain.orderBy(*order).write.mode("overwrite" if force else "errorifexists").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def files_of(spark: SparkSession, where: str) -> tuple[Callable[[str], JavaObject], JavaObject]:
    """How to name a path, and the file system that holds `where`: local or shared."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    return path, path(where).getFileSystem(context._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, where: str, text: str) -> None:
    """One text file, in UTF-8; an existing one is replaced."""
    path, files = files_of(spark, where)
    out = files.create(path(where), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


_LOG = "_commits"


class VersionConflict(FileExistsError):
    """Another writer has committed since the version that this one started from."""


def _claimed(spark: SparkSession, root: str) -> list[int]:
    """Numbers that the commit log holds, in order."""
    path, files = files_of(spark, root)
    log = path(f"{root}/{_LOG}")
    names = [x.getPath().getName() for x in files.listStatus(log)] if files.exists(log) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _written(spark: SparkSession, root: str) -> list[int]:
    path, files = files_of(spark, root)
    names = [x.getPath().getName() for x in files.listStatus(path(root))]
    return [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]


def latest_version(spark: SparkSession, root: str) -> int:
    """The last version that readers may see, 0 if there is none: its number is in the log and its rows are in place."""
    path, files = files_of(spark, root)
    return next((n for n in reversed(_claimed(spark, root)) if files.exists(path(f"{root}/v={n}"))), 0)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a committed version, the last one by default."""
    n = latest_version(spark, root) if version is None else version
    if n not in _claimed(spark, root):
        raise FileNotFoundError(f"{root} has no version {n}")
    return spark.read.parquet(f"{root}/v={n}")


def write_version(df: DataFrame, root: str, base: int | None = None) -> str:
    """Writes the next v=<n> under a root on any file system, completely or not at all, and gives its path; older versions stay.

    Rows go to a folder of the writer's own. The number is taken by creating its file in the commit log, which succeeds for
    one writer only; then the folder gets its name. A writer that dies in between leaves a number without rows, which
    readers and later writers pass over. base: the version that the rows were made from; if there is a later number, the
    write is refused with VersionConflict and nothing of it stays. Without a base the next free number is taken.
    """
    spark = df.sparkSession
    path, files = files_of(spark, root)
    part = f"{root}/.part-{uuid.uuid4().hex}"
    df.write.parquet(part)
    files.mkdirs(path(f"{root}/{_LOG}"))
    try:
        while True:
            n = max([*_claimed(spark, root), *_written(spark, root), 0]) + 1
            if base is not None and n != base + 1:
                raise VersionConflict(f"{root} is at {n - 1}, not at {base}")
            if _claim(spark, root, n, base):
                break
        if not files.rename(path(part), path(f"{root}/v={n}")):
            raise OSError(f"{part} can't be renamed to v={n}")
    finally:
        files.delete(path(part), True)
    return f"{root}/v={n}"


def _claim(spark: SparkSession, root: str, n: int, base: int | None) -> bool:
    """Whether the number's file could be created: False if another writer has it."""
    path, files = files_of(spark, root)
    where = path(f"{root}/{_LOG}/{n:020d}.json")
    try:
        out = files.create(where, False)
    except Py4JJavaError:
        if files.exists(where):
            return False
        raise
    try:
        out.write(bytearray(json.dumps({"version": n, "base": base}).encode()))
    finally:
        out.close()
    return True


def write_manifest(spark: SparkSession, folder: str, counts: dict[str, int]) -> dict:
    """manifest.json with counts and the SHA-256 of every data file below a folder, and SHA256SUMS beside it.

    The executors hash the files, each of which must be below 2 GB; only names and sums come to the driver.
    """
    path, files = files_of(spark, folder)
    root = files.makeQualified(path(folder)).toString() + "/"
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.substring(F.regexp_replace("path", "^file:/+", "file:/"), len(root) + 1, 1 << 20)
    rows = read.select(name.alias("name"), F.sha2("content", 256).alias("sum")).where(~F.col("name").isin("manifest.json", "SHA256SUMS"))
    sums = {r["name"]: r["sum"] for r in rows.orderBy("name").collect()}
    out = {"counts": counts, "sha256": sums}
    put_text(spark, f"{folder}/manifest.json", json.dumps(out, indent=1, sort_keys=True))
    put_text(spark, f"{folder}/SHA256SUMS", "".join(f"{v}  {k}\n" for k, v in sums.items()))
    return out


def planned(df: DataFrame, path: str, write: bool = False) -> DataFrame:
    """A dry run unless write is set: the rows come back either way, only the action differs."""
    if write:
        df.write.mode("errorifexists").parquet(path)
    return df


def embed_json(df: DataFrame, template: str, mark: str = "__DATA__", most: int = 100_000) -> str:
    """A page with the rows as JSON in it; "</" is escaped, so a row can't end the script. One page holds `most` rows; more are refused."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one page")
    rows = ",".join(r["j"] for r in df.select(F.to_json(F.struct("*")).alias("j")).collect())
    return template.replace(mark, f"[{rows}]".replace("</", "<\\/"))


def markdown_sections(df: DataFrame, group: str, line: Column, order: list[str]) -> DataFrame:
    """group, section: a heading and a list of the group's lines in order, as Markdown."""
    rows = df.select(group, F.struct(*order, line.alias("_line")).alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: F.concat(F.lit("- "), r["_line"])), "\n")
    return rows.groupBy(group).agg(body.alias("body")).select(group, F.concat(F.lit("## "), F.col(group).cast("string"), F.lit("\n\n"), F.col("body"), F.lit("\n")).alias("section"))


def edited_lines(lines: DataFrame, edits: DataFrame, keys: list[str], order: str = "n", line: str = "line") -> DataFrame:
    """order, line after edits of JSON lines; every line that no edit names stays byte for byte as it is.

    edits: the key columns (strings, as in the JSON) and changes (a JSON object of fields to set). Changed lines are
    written in the style of the file, compact or spaced, found from lines that stay; if no such line is in one of the
    styles, it raises. Blank lines and lines that aren't JSON objects stay. Two edits of one key are refused.
    """
    read = F.from_json(line, ", ".join(f"`{k}` string" for k in keys))
    rows = lines.select(order, line, read.alias("_read")).select(order, line, *(F.col(f"_read.{k}").alias(k) for k in keys))
    if edits.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError("a key has several edits")
    joined = rows.join(edits.select(*keys, F.col("changes").alias("_changes")), keys, "left")
    styles = {"compact": (",", ":"), "spaced": (", ", ": ")}

    def written(text: str, changes: str | None, style: str) -> str | None:
        try:
            return json.dumps(json.loads(text) | json.loads(changes or "{}"), ensure_ascii=False, separators=styles[style])
        except (ValueError, TypeError):
            return None

    same = F.udf(lambda text: [k for k in styles if written(text, None, k) == text], "array<string>")
    found = joined.where(F.col("_changes").isNull() & F.col(line).startswith("{")).select(F.explode(same(line)).alias("style")).groupBy("style").count().orderBy(F.desc("count"), "style").first()
    if found is None:
        raise ValueError("no line that stays is written in a known style")
    change = F.udf(lambda text, changes: written(text, changes, found["style"]), "string")
    return joined.select(order, F.when(F.col("_changes").isNull(), F.col(line)).otherwise(change(line, "_changes")).alias(line))
