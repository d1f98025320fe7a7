"""Repairs, rules and checks on names and sentences assembled from parts and documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import predicates as P
from ..operators.rules import SMELL_RULES, first_reason
from ..session import ship_package, table
from .base import SENTENCES_SQL, Plans, sentences, sql_reason
from .cues import SMELLS

#: Ways of writing a part's name {n}, brand {b} and size {k} into text, by the remainder of its key.
MISREAD = ("rnethyl l-{n}", "{k} - methyl {n}", "{k}a {n}", "(lh)-{n}", "{n}")
SPAN = ("{n}", "Example {k}: {n}", "({n}", "{n}]", "zzyx {n}")
LABEL = ("Example {k}: {n} ({b})", "{n}, i.e. a {b}", "compound of formula (IV) {n}", "{n} (E,Z) x", "{n}")
BESIDE = ("It has a note reminiscent of {n}.", "{n} is stronger than {n}.", "It is stronger than musk; a {n} is near.", "It was used in place of {n} oil.")
CLAIM = ("{n} has body and is devoid of any minty note", "Had {n} been used it would have a minty note", "{n} lifts this minty essential oil composition", "{n} is an oily liquid and minty", "{n} has a minty charm") + (
    "{n} has body. {b} gives a minty freshness", "{n} is like minty hydrocarbons and has minty charm", "{n} is full whereas {b} is minty", "If {n} instead of {b} is taken the blend is minty", "{n} of Pat. No. 3 and by approx. 0.5. 6 parts is minty", "{n} is a minty liquid and an oily solid",
)
DECIDED = ("It causes the tobacco to have a {n} note", "It lends body to the soup and more of {n}", "7 and 8-acetyl {n} are both woody", "The ketone {n} is woody", "The soupy note of {n} is woody")


def _pick(ways: tuple[str, ...]) -> Column:
    """The way that the part's key picks, filled in."""
    chosen = reduce(lambda out, i: out.when(F.col("p_partkey") % len(ways) == i, F.lit(ways[i])), range(1, len(ways)), F.when(F.col("p_partkey") % len(ways) == 0, F.lit(ways[0])))
    return F.replace(F.replace(F.replace(chosen, F.lit("{n}"), F.col("p_name")), F.lit("{b}"), F.col("p_brand")), F.lit("{k}"), F.col("p_size").cast("string"))


def _parts(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    return table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")


def repaired_names(spark: SparkSession, d: str) -> DataFrame:
    """Names after all repairs, with the rules that changed them."""
    name, rules = T.repaired("x", [r for r, *_ in T.REPAIRS])
    return _parts(spark, d).withColumn("x", _pick(MISREAD)).select("p_partkey", name.alias("name"), F.array_join(rules, ",").alias("rules"))


def ring_names(spark: SparkSession, d: str) -> DataFrame:
    """Digits misread as letters, between a ring's brackets and outside."""
    low = F.when(F.col("p_partkey") % 2 == 0, "l").otherwise("O")
    x = F.concat(F.lit("bicyclo["), F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 10).cast("string"), F.lit("."), low, F.lit("]"), low, F.lit("-"), F.col("p_name"))
    return _parts(spark, d).withColumn("x", x).select("p_partkey", T.ring_brackets("x").alias("name"))


def repaired_spans(spark: SparkSession, d: str) -> DataFrame:
    rows = _parts(spark, d).withColumns({"span": _pick(SPAN), "s": F.concat(F.lit("the ("), F.col("p_name"), F.lit(") beside "), F.col("p_name"), F.lit("] of "), F.col("p_brand"))})
    return rows.select("p_partkey", T.repaired_span("span", "s").alias("r")).select("p_partkey", "r.span", "r.how")


def cleaned_names(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).withColumn("x", _pick(LABEL)).select("p_partkey", T.clean_name("x").alias("name"))


def similar_names(spark: SparkSession, d: str) -> DataFrame:
    """How alike a part's name is to what is left of it without its last letters, as many as the key says."""
    rows = _parts(spark, d).withColumn("b", F.substring("p_name", F.lit(1), F.length("p_name") - (F.col("p_partkey") % 4).cast("int")))
    return rows.select("p_partkey", F.round(T.similarity("p_name", "b"), 6).alias("ratio"))


def compared_names(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).withColumn("s", _pick(BESIDE)).select("p_partkey", P.only_compared("s", "p_name").alias("compared"))


def attribution_checks(spark: SparkSession, d: str) -> DataFrame:
    """What speaks against giving a sentence's descriptors to the part named in it, by all checks; its brand is another name."""
    rows = _parts(spark, d).withColumn("s", _pick(CLAIM))
    checks = P.attribution_checks("s", F.array("p_name"), F.array(F.lit("minty"), F.lit("oily")), T.spans_of("p_brand", "s"))
    return rows.select("p_partkey", F.array_join(checks, " ").alias("checks"))


def decision_reversals(spark: SparkSession, d: str) -> DataFrame:
    prefix = F.element_at(F.array(*(F.lit(x) for x in ("Z-methyl ", "4-alkyl ", "EZ-methyl ", ""))), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = _parts(spark, d).withColumn("s", _pick(DECIDED))
    return rows.select("p_partkey", P.taken_back("s", F.array(F.concat(prefix, F.col("p_name")))).alias("taken_back"))


def smell_rule_reasons(spark: SparkSession, d: str) -> DataFrame:
    """What the whole cascade says of each document's sentences: every second as it is, the others behind one of those written for its rules."""
    own = F.element_at(F.array(*map(F.lit, SMELLS)), ((F.col("doc_id") + F.col("pos")) % len(SMELLS) + 1).cast("int"))
    s = F.when(F.col("pos") % 2 == 0, F.col("s")).otherwise(F.concat(own, F.lit(" "), F.substring("s", 1, 60)))
    return sentences(spark, d).select("lang", first_reason(s, SMELL_RULES).alias("reason")).groupBy("lang", "reason").agg(F.count("*").alias("n"))


def _sql_pick(ways: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(ways))
    return f"replace(replace(replace(CASE p_partkey % {len(ways)} {cases} END, '{{n}}', p_name), '{{b}}', p_brand), '{{k}}', p_size::VARCHAR)"


def _cases(*answers: str) -> str:
    return f"CASE p_partkey % {len(answers)} " + " ".join(f"WHEN {i} THEN {a}" for i, a in enumerate(answers)) + " END"


_OWN = "list_value(" + ", ".join("'" + s.replace("'", "''") + "'" for s in SMELLS) + ")"
PLANS: Plans = {
    "repaired_names": (repaired_names, f"""SELECT p_partkey, {_cases("'methyl 1-' || p_name", "p_size::VARCHAR || '-methyl ' || p_name", "p_size::VARCHAR || 'a-' || p_name", "'(1H)-' || p_name", "p_name")} AS name, {_cases("'L1,R1'", "'W1'", "'W2'", "'H1'", "''")} AS rules FROM part"""),
    "ring_names": (ring_names, "SELECT p_partkey, 'bicyclo[' || p_size::VARCHAR || '.' || (p_partkey % 10)::VARCHAR || '.' || CASE WHEN p_partkey % 2 = 0 THEN '1]l' ELSE '0]O' END || '-' || p_name AS name FROM part"),
    "repaired_spans": (repaired_spans, f"""SELECT p_partkey, {_cases("p_name", "p_name", "'(' || p_name || ')'", "p_name", "NULL")} AS span, {_cases("'unchanged'", "'label'", "'bracket restored'", "'orphan trimmed'", "'not verbatim'")} AS how FROM part"""),
    "cleaned_names": (cleaned_names, f"""SELECT p_partkey, {_cases("p_name", "p_name", "NULL", "p_name || ' (E,Z) x'", "p_name")} AS name FROM part"""),
    "similar_names": (similar_names, "SELECT p_partkey, round(2 * (length(p_name) - p_partkey % 4)::DOUBLE / (2 * length(p_name) - p_partkey % 4), 6) AS ratio FROM part"),
    "compared_names": (compared_names, f"SELECT p_partkey, {_cases('true', 'false', 'false', 'true')} AS compared FROM part"),
    "attribution_checks": (attribution_checks, f"""SELECT p_partkey, {_cases("'NEGATED:minty'", "'COUNTERFACT'", "'COMPOSITION:minty'", "'PHYSICAL:oily'", "''", "'GLUED:minty NEARER:minty'", "'CLASS:minty'", "'NEARER:minty'", "'COUNTERFACT NEARER:minty'", "''", "'PHYSICAL:oily'")} AS checks FROM part"""),
    "decision_reversals": (decision_reversals, "SELECT p_partkey, p_partkey % 5 IN (0, 1, 2) OR p_partkey % 4 IN (0, 1) AS taken_back FROM part"),
    "smell_rule_reasons": (
        smell_rule_reasons,
        f"WITH {SENTENCES_SQL}, o AS (SELECT {_OWN} AS own), x AS (SELECT lang, CASE WHEN pos % 2 = 0 THEN s ELSE own[(doc_id + pos) % {len(SMELLS)} + 1] || ' ' || substring(s, 1, 60) END AS s FROM s, o) "
        f"SELECT lang, reason, count(*) AS n FROM (SELECT lang, {sql_reason('s', SMELL_RULES)} AS reason FROM x) GROUP BY lang, reason",
    ),
}
