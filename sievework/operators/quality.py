"""Checks as relations: what violates a rule is a table that must be empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise, naming some rows, if there are violations: a partial result is never passed on."""
    some = violations.limit(5).collect()
    if some:
        raise ValueError(f"{what}: {some}")


def vocabulary_map(forms: DataFrame) -> DataFrame:
    """form, tag in lower case; fails if a form has two tags."""
    low = forms.select(F.lower(F.trim("form")).alias("form"), "tag").where(F.col("form") != "").distinct()
    require_empty(low.groupBy("form").agg(F.countDistinct("tag").alias("tags")).where(F.col("tags") > 1), "forms with several tags")
    return low


def complete_only(walk: DataFrame, failed: str) -> DataFrame:
    """Refuses a walk of which any window failed."""
    require_empty(walk.where(F.size(failed) > 0), "windows failed")
    return walk


def with_suffixes(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Repeated keys get -2, -3 and so on, in order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_n", n).withColumn(key, F.when(F.col("_n") > 1, F.concat(key, F.lit("-"), F.col("_n").cast("string"))).otherwise(F.col(key))).drop("_n")


def trust_class(tier: Column, witness: Column, check: Column) -> Column:
    """How far a resolved name may be trusted."""
    return (
        F.when(tier.isNull(), "none").when(check == "different", "disputed").when(tier == "verbatim", "verbatim").when(check == "agree", "check").when(witness, "repaired+witness").when(tier == "stereo_dropped", "flat").otherwise("provisional")
    )


def tiers(names: DataFrame, key: str, resolver: DataFrame, steps: list[tuple[str, Column]], overrides: DataFrame) -> DataFrame:
    """name, tier, identity. A name with an override takes it; else the first step whose form of the name the resolver knows.

    resolver: form, identity, parts; several parts are refused at every step. overrides: the key column, identity.
    """
    known = resolver.where(F.col("parts") == 1).groupBy("form").agg(F.min("identity").alias("identity"))
    out = names.join(overrides.select(key, F.col("identity").alias("_override")), key, "left")
    found = [F.when(F.col("_override").isNotNull(), F.struct(F.lit("override").alias("tier"), F.col("_override").alias("identity")))]
    for n, (tier, form) in enumerate(steps):
        side = known.select(F.col("form").alias(f"_f{n}"), F.col("identity").alias(f"_i{n}"))
        out = out.withColumn(f"_k{n}", form).join(side, F.col(f"_k{n}") == F.col(f"_f{n}"), "left")
        found.append(F.when(F.col(f"_i{n}").isNotNull(), F.struct(F.lit(tier).alias("tier"), F.col(f"_i{n}").alias("identity"))))
    best = F.coalesce(*found)
    return out.select(*names.columns, F.coalesce(best["tier"], F.lit("unresolved")).alias("tier"), best["identity"].alias("identity"))


def known_terms(asked: list[str], vocabulary: DataFrame, term: str, most: int = 3) -> list[str]:
    """The terms asked for, if the vocabulary has all of them; else raises and says what was likely meant.

    The executors rank all terms by edit distance; the nearest few for each term that is unknown come to the driver.
    """
    held = {r[term] for r in vocabulary.where(F.col(term).isin(asked)).select(term).distinct().collect()}
    told = []
    for a in dict.fromkeys(asked):
        if a not in held:
            far = F.levenshtein(F.lower(term), F.lit(a.lower()))
            near = vocabulary.where(far <= max(2, len(a) // 2)).select(term, far.alias("far")).distinct().orderBy("far", term).limit(most).collect()
            told.append(f"{a}: not in the vocabulary, nearest {[r[term] for r in near] or 'none'}")
    if told:
        raise ValueError("; ".join(told))
    return asked
