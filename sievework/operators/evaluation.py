"""Samples that don't depend on the engine, and measures of a filter against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: str, key: Column) -> Column:
    """The sort key of seeded samples."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def sample(rows: DataFrame, key: str, seed: str, n: int, first: Column | None = None) -> DataFrame:
    """n rows; those for which `first` is true come before the others."""
    order = [first.desc()] if first is not None else []
    return rows.orderBy(*order, draw(seed, F.col(key)), key).limit(n)


def stratified(rows: DataFrame, stratum: str, key: str, seed: str, n: int) -> DataFrame:
    w = Window.partitionBy(stratum).orderBy(draw(seed, F.col(key)), key)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def precision_recall(rows: DataFrame, got: Column, want: Column, weight: Column | None = None) -> DataFrame:
    """tp, fp, fn, precision, recall, f1; no rows in a denominator give 0."""
    weight = F.lit(1.0) if weight is None else weight
    total = lambda c: F.coalesce(F.sum(F.when(c, weight)), F.lit(0.0))
    sums = rows.agg(total(got & want).alias("tp"), total(got & ~want).alias("fp"), total(~got & want).alias("fn"))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.select(*(F.round(c, 6).alias(c) for c in ("tp", "fp", "fn")), F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(ratio(2 * p * r, p + r), 6).alias("f1"))


def confusion(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    return rows.groupBy(truth, predicted).agg(F.count("*").alias("n"))


def stratum_weights(rows: DataFrame, sampled: DataFrame, stratum: str) -> DataFrame:
    """stratum, weight: rows that a sampled row stands for."""
    return rows.groupBy(stratum).agg(F.count("*").alias("_all")).join(sampled.groupBy(stratum).agg(F.count("*").alias("_some")), stratum).select(stratum, (F.col("_all") / F.col("_some")).alias("weight"))


def agreement(rows: DataFrame, truth: str, predicted: str, names: Column, predicted_names: Column) -> DataFrame:
    """n, agreed, rejected, reject_precision, approved, same_names: two booleans compared, and the names (arrays, as sets
    without case) of rows that both approve. A null decision counts as neither; nothing rejected gives a precision of 0."""
    as_set = lambda xs: F.array_sort(F.array_distinct(F.transform(xs, lambda x: F.lower(x))))
    got, want = F.col(predicted), F.col(truth)
    out = rows.agg(
        F.count("*").alias("n"),
        F.count_if(got == want).alias("agreed"),
        F.count_if(~got).alias("rejected"),
        F.count_if(~got & ~want).alias("_right"),
        F.count_if(got & want).alias("approved"),
        F.count_if(got & want & (as_set(names) == as_set(predicted_names))).alias("same_names"),
    )
    return out.select("n", "agreed", "rejected", F.round(ratio(F.col("_right"), F.col("rejected")), 6).alias("reject_precision"), "approved", "same_names")
