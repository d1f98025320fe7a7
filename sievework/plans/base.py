"""What the queries share: tables, sentences, the small vocabulary, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.rules import AFTER, BEFORE, DATA_RULES, RuleSet
from ..session import table

Query = Callable[[SparkSession, str], DataFrame]
#: name -> (query, SQL or None)
Plans = dict[str, tuple[Query, str | None]]

# A vocabulary over words that occur in the data: surface form -> tag.
VOCABULARY = {
    "the": "article", "les": "article", "der": "article", "die": "article", "el": "article",
    "of": "relation", "with": "relation", "para": "relation", "pour": "relation", "von": "relation",
    "and": "link", "und": "link", "que": "link", "that": "link",
    "is": "being", "are": "being", "ist": "being", "be": "being",
    "of the": "partition", "de la": "partition",
    "ction": "never", "zzyx": "never",
}
FORMS = "|".join(sorted(VOCABULARY, key=lambda t: (-len(t), t)))
#: Matches of the vocabulary, longest form first; borders are tested by look-around here and by splitting in SQL.
FORM_PATTERN = rf"(?i)(?<![\p{{L}}\p{{N}}_])({FORMS})(?![\p{{L}}\p{{N}}_])"
VOCABULARY_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in VOCABULARY.items()) + ") v(form, tag)"


def values(spark: SparkSession, rows: dict[str, str], names: tuple[str, str]) -> DataFrame:
    """A two-column relation of constants."""
    return spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(a).alias(names[0]), F.lit(b).alias(names[1])) for a, b in rows.items()))).alias("r")).select("r.*")


def vocabulary(spark: SparkSession) -> DataFrame:
    return values(spark, VOCABULARY, ("form", "tag"))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, pos, s: normalised, split sentences of documents."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", F.posexplode(T.sentences(T.norm_text("text"))).alias("pos", "s"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, w: every word."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.explode(T.words("text")).alias("w"))


def sql_norm(x: str) -> str:
    for a, b in T.NAMED_ENTITIES.items():
        x = f"replace({x}, '{a}', '{b.replace("'", "''")}')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


SENTENCES_SQL = rf"""
n AS (SELECT doc_id, lang, source, {sql_norm("text")} AS t FROM documents),
l AS (SELECT doc_id, lang, source, string_split(regexp_replace(t, '([.;])\s+([A-Z0-9(])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS l FROM n),
s AS (SELECT doc_id, lang, source, unnest(l) AS s, unnest(range(len(l)))::INTEGER AS pos FROM l)
"""
TOKENS_SQL = r"tok AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM documents)"


def sql_reason(s: str, rules: RuleSet = DATA_RULES) -> str:
    quote = lambda p: p.replace("'", "''")
    out = f"CASE WHEN NOT (length({s}) > {rules.shortest} AND length({s}) < {rules.longest}) THEN 'length'"
    for p, label in rules.exclude:
        out += f" WHEN regexp_matches({s}, '{quote(p)}') THEN '{label}'"
    out += f" WHEN NOT regexp_matches({s}, '{quote(rules.head)}') THEN '{rules.missing[0]}'"
    out += f" WHEN NOT ({' OR '.join(f"regexp_matches({s}, '{quote(p)}')" for p in rules.attribution)}) THEN '{rules.missing[1]}'"
    return out + f" WHEN NOT {sql_named(s, rules)} THEN '{rules.missing[2]}' ELSE 'kept' END"


def sql_named(s: str, rules: RuleSet = DATA_RULES) -> str:
    stop = ", ".join(f"'{w}'" for w in rules.stop)
    sure = " OR ".join(f"regexp_matches({s}, '{p}')" for p in rules.sure_names)
    return f"({sure} OR len(list_filter(regexp_extract_all({s}, '{rules.suffix_token}'), lambda w: lower(w) NOT IN ({stop}))) > 0)"


def sql_gates_failed(s: str, rules: RuleSet) -> str:
    attributed = " OR ".join(f"regexp_matches({s}, '{p}')" for p in rules.attribution)
    gates = (f"length({s}) > {rules.shortest} AND length({s}) < {rules.longest}", f"regexp_matches({s}, '{rules.head}')", attributed, sql_named(s, rules))
    return "(" + " + ".join(f"(NOT ({g}))::INTEGER" for g in gates) + ")"


def sql_has(s: str, word: str) -> str:
    return f"regexp_matches({s}, '(?i){BEFORE}{word}{AFTER}')"
