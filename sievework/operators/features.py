"""Vectors and tables for models and maps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import norm2
from ..session import small_side, stash
from .order import running

#: Points that one map holds; the method compares all with all, so more are refused rather than sampled.
MOST_POINTS = 5_000
#: Parts that a range is cut into when values are looked for by counting, and rounds after which that fails. Numbers of one
#: size take three or four rounds; every round leaves at most a thousandth of the range.
PARTS, MOST_ROUNDS = 1_024, 250
#: Places that are broadcast to the rows; more are joined as Spark plans it.
BROADCAST_RANKS = 1_000_000
#: Distinct values whose codes are broadcast.
BROADCAST_CODES = 1_000_000


def unit(v: Column | str) -> Column:
    length = norm2(v)
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), length))


#: Queries that meet, and rows that they meet, in one task; queries whose scores are held at a time.
QUERY_BLOCK, ROW_BLOCK, AT_ONCE = 16_384, 8_192, 256


def best_dots(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the dot products of queries (query_id, q) with rows (vec_id, v) of another id among which each query's k highest are, rounded to nine digits, ties to the smaller vec_id.

    A block of queries and one of rows are multiplied as matrices, which finds what may be among the best; the products
    of those are added up in order, as `N.dot` does. All vectors are of one length, finite and without nulls.
    """
    import numpy as np
    import pyarrow as pa

    n_q, n_r = queries.count() // QUERY_BLOCK + 1, rows.count() // ROW_BLOCK + 1
    part = lambda of, n: F.pmod(F.xxhash64(of), F.lit(n).cast("long"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.select("query_id", "q", part("query_id", n_q).alias("qb"), every(n_r).alias("rb"))
    right = rows.select("vec_id", "v", every(n_q).alias("qb"), part("vec_id", n_r).alias("rb"))

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple] = [(np.array([], np.int64), np.array([], np.int64), np.array([], float))]
        if asked.num_rows and held.num_rows:
            q, v = (t[x].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) for t, x in ((asked, "q"), (held, "v")))
            q_ids, v_ids = asked["query_id"].to_numpy(), held["vec_id"].to_numpy()
            for at in range(0, len(q), AT_ONCE):
                ids, some = q_ids[at : at + AT_ONCE], q[at : at + AT_ONCE]
                about = some @ v.T
                about[ids[:, None] == v_ids] = -np.inf
                least = np.partition(about, -k, axis=1)[:, -k] if len(v) > k else np.full(len(some), -np.inf)
                one, other = np.nonzero((about >= least[:, None] - 1e-8) & (about > -np.inf))
                score = np.zeros(len(one))
                for i in range(v.shape[1]):
                    score += some[one, i] * v[other, i]
                order = np.lexsort((v_ids[other], -score, one))
                one, other, score = one[order], other[order], score[order]
                # of equal scores only the k smallest ids can be among the best
                first = np.r_[True, (one[1:] != one[:-1]) | (score[1:] != score[:-1])][: len(one)]
                starts = np.flatnonzero(first)
                keep = np.arange(len(one)) - np.repeat(starts, np.diff(np.r_[starts, len(one)])) < k
                out.append((ids[one[keep]], v_ids[other[keep]], score[keep]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    return left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(meet, "query_id long, vec_id long, score double")


def ranked_values(rows: DataFrame, group: str, x: str, ranks: Column) -> DataFrame:
    """_g, rank, v: the values that stand at given places (from 0) of each group, found by counting, without sorting a group.

    ranks: an array over the number of the group's values, n. Each round cuts the range that holds a place into PARTS,
    counts what lies in each, and keeps the part where the place is; it ends when every range holds a single value. What
    is grouped in a round is PARTS counts for each place, however large the group. Null groups are one group; null and
    not-a-number values take no part.
    """
    own = rows.select(F.col(group).alias("_g"), F.col(x).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    start = own.groupBy("_g").agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    now = stash(start.select("_g", F.explode(F.array_distinct(ranks)).alias("rank"), F.lit(0).cast("long").alias("before"), "lo", "hi"))
    for _ in range(MOST_ROUNDS):
        open_ = now.where("lo < hi")
        if not open_.limit(1).count():
            return now.select("_g", "rank", F.col("lo").alias("v"))
        side = small_side(open_.withColumnRenamed("_g", "_h"), BROADCAST_RANKS)
        met = own.join(side, F.col("_g").eqNullSafe(F.col("_h")) & F.col("_v").between(F.col("lo"), F.col("hi")))
        share = (F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)  # halved, so that no difference overflows
        part = F.least(F.floor(F.greatest(share, F.lit(0.0)) * PARTS), F.lit(PARTS - 1))
        counts = met.groupBy("_g", "rank", "before", part.alias("part")).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        upto = F.col("before") + F.sum("n").over(Window.partitionBy("_g", "rank").orderBy("part"))  # PARTS rows at most
        held = counts.withColumn("_upto", upto).where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n")))
        now = stash(now.where("lo = hi").unionByName(held.select("_g", "rank", (F.col("_upto") - F.col("n")).alias("before"), "lo", "hi")))
    raise RuntimeError(f"places weren't found in {MOST_ROUNDS} rounds")


def exact_quantiles(rows: DataFrame, group: str, x: str, shares: list[float]) -> DataFrame:
    """_g, q: for each group its quantiles at the shares, between neighbours in proportion, for groups of any size."""
    at = [(F.col("n") - 1) * F.lit(s) for s in shares]
    places = stash(ranked_values(rows, group, x, F.array(*(f(p).cast("long") for p in at for f in (F.floor, F.ceil)))))
    n = rows.where(F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double"))).groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("n"))
    found = places.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("_m"))  # two places for each share

    def value(p: Column) -> Column:
        low, high = (F.try_element_at("_m", f(p).cast("long")) for f in (F.floor, F.ceil))
        return low + (high - low) * (p - F.floor(p))

    met = n.withColumnRenamed("_g", "_h").join(found, F.col("_h").eqNullSafe(F.col("_g")))
    return met.select("_g", F.array(*map(value, at)).alias("q"))


def clip_rescale(rows: DataFrame, group: str, x: str, low: float = 0.03, high: float = 0.97) -> DataFrame:
    """x on 0 to 1 between two percentiles of its group, clipped beyond; exact, with no task that holds a group."""
    bounds = small_side(exact_quantiles(rows, group, x, [low, high]).select(F.col("_g"), F.col("q").alias("_b")), BROADCAST_RANKS)
    low_x, high_x = F.get("_b", F.lit(0)), F.get("_b", F.lit(1))
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.col(x) - low_x, high_x - low_x)))
    return rows.join(bounds, F.col(group).eqNullSafe(F.col("_g"))).withColumn("scaled", scaled).drop("_b", "_g")


def profiles(rows: DataFrame, entity: str, kind: str, kinds: list[str]) -> DataFrame:
    """entity, profile: damped counts (square roots) of each kind, in order."""
    counts = rows.groupBy(entity).pivot(kind, kinds).count().na.fill(0)
    return counts.select(entity, F.array(*(F.sqrt(F.col(f"`{k}`").cast("double")) for k in kinds)).alias("profile"))


def embed(rows: DataFrame, key: str, vector: str, perplexity: float = 20.0, rounds: int = 250, seed: int = 7) -> DataFrame:
    """key, x, y: exact t-SNE of cosine distances. One group in one task, so it raises beyond MOST_POINTS rows."""
    if rows.limit(MOST_POINTS + 1).count() > MOST_POINTS:
        raise ValueError(f"more than {MOST_POINTS} points")
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        every = pd.concat(list(frames)) if frames is not None else pd.DataFrame()
        if not len(every):
            return
        every = every.sort_values(key)
        x = np.stack(every[vector].map(lambda v: np.asarray(v, float)))
        x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-12
        far = np.clip(1 - x @ x.T, 0, None)
        n = len(x)
        p = np.zeros((n, n))
        target = np.log(min(perplexity, max(2, (n - 1) / 3)))
        for i in range(n):
            low, high, beta = 0.0, np.inf, 1.0
            others = np.delete(far[i], i)
            for _ in range(40):
                w = np.exp(-beta * (others - others.min(initial=0)))
                share = w / w.sum() if w.sum() else w
                entropy = -(share * np.log(share + 1e-300)).sum()
                if abs(entropy - target) < 1e-4:
                    break
                if entropy > target:
                    low, beta = beta, beta * 2 if high == np.inf else (beta + high) / 2
                else:
                    high, beta = beta, (beta + low) / 2
            p[i, np.arange(n) != i] = share if n > 1 else 0
        p = np.maximum((p + p.T) / (2 * n), 1e-12)
        y = np.random.default_rng(seed).normal(0, 1e-4, (n, 2))
        step, gain = np.zeros_like(y), np.ones_like(y)
        for t in range(rounds):
            diff = y[:, None] - y[None]
            q = 1 / (1 + (diff**2).sum(-1))
            np.fill_diagonal(q, 0)
            shared = np.maximum(q / max(q.sum(), 1e-12), 1e-12)
            grad = 4 * (((p * (12 if t < 80 else 1) - shared) * q)[:, :, None] * diff).sum(1)
            gain = np.where(np.sign(grad) == np.sign(step), np.maximum(gain * 0.8, 0.01), gain + 0.2)
            step = (0.5 if t < 80 else 0.8) * step - 100 * gain * grad
            y = y + step
            y -= y.mean(0)
        yield pd.DataFrame({key: every[key].to_numpy(), "x": y[:, 0], "y": y[:, 1]})

    return rows.select(key, vector).coalesce(1).mapInPandas(run, f"{key} {kind}, x double, y double")


def auc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve by ranks; equal scores count half. Scores are dealt out by ranges, so no task has all of them."""
    by = rows.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    placed = running(by, [], [F.col(score)], {"upto": F.col("neg")})
    won = placed.withColumn("won", F.col("pos") * (F.col("upto") - F.col("neg") + F.col("neg") / 2))
    return won.agg((F.sum("won") / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def dictionary_codes(rows: DataFrame, column: str, most: int = BROADCAST_CODES) -> DataFrame:
    """rows with code: the place (from 0) of the column's value among its distinct values, however many there are; a null's is null."""
    values = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("_value")).distinct()
    codes = small_side(running(values, [], [F.col("_value")]).select("_value", (F.col("place") - 1).alias("code")), most)
    return rows.join(codes, F.col(column) == F.col("_value"), "left").drop("_value")
