"""Places and totals along an order, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stash


def running(rows: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column] | None = None) -> DataFrame:
    """rows with place (from 1 in each group) and running sums of whole numbers, as a window over the whole group gives them.

    Rows are dealt out by ranges of group and order, so a group with a third of all rows lies in many tasks; the totals of
    a group's ranges, a few numbers each, are added up first, and each range then starts from those before it. The order
    must be total for the result to be defined. Null groups are one group.
    """
    sums = sums or {}
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = stash(rows.withColumns({f"_of_{k}": v for k, v in sums.items()}).repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()))
    totals = held.groupBy(*group, "_part").agg(F.count("*").alias("_n"), *(F.sum(f"_of_{k}").alias(f"_t_{k}") for k in sums))
    ranges = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = [F.coalesce(F.sum(x).over(ranges), F.lit(0)).alias(f"_ahead{x}") for x in ("_n", *(f"_t_{k}" for k in sums))]
    before = totals.select(*(F.col(g).alias(f"_g_{g}") for g in group), F.col("_part").alias("_p"), *ahead)
    own = Window.partitionBy(*group, "_part").orderBy(*order)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    on = F.col("_part") == F.col("_p")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    placed = held.withColumns({"_n": F.row_number().over(own), **{f"_t_{k}": F.sum(f"_of_{k}").over(upto) for k in sums}}).join(before, on)
    return placed.select(*rows.columns, (F.col("_n") + F.col("_ahead_n")).cast("long").alias("place"), *((F.col(f"_t_{k}") + F.col(f"_ahead_t_{k}")).alias(k) for k in sums))
