"""Exact top-k search by inner product over a table of distances to pivots.

The table holds each vector's distances to many pivots. For a query q and a candidate c, |d(q, p) - d(c, p)| is at most
d(q, c) for every pivot p. All pivots together say more: with the norms, the distances give the places of q and c in the
span of the pivots and how far they lie from it, and d(q, c) is least where both lie on the same side. This bound is
never below that of a single pivot; as q.c = (|q|^2 + |c|^2 - d^2) / 2 it bounds the inner product from above.
Candidates are evaluated in the order of their bounds until the next bound can't reach the k-th best score. Queries and
candidates meet in pairs of blocks; what leaves a pair is k rows for each query. How many pivots pay is measured on the
sample that they come from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package, stash
from .blocks import bound_batches

K, SCALE, EVERY = 5, 256, 50
#: Vectors from which pivots are chosen and by which each query's first bound is found, and those that try out how many pivots pay.
SAMPLE, TRIES = 2_000, 64
QUERY_BLOCK, CANDIDATE_BLOCK = 2_048, 8_192
#: Sums of products stay exact in doubles up to here.
_EXACT = float(1 << 53)
#: A pivot must be farther from the span of those before it than this share of the farthest.
_APART = 1e-3


def usable(x: Column) -> Column:
    """Not null, not holding null, NaN or an infinity."""
    return x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))


class Pivots:
    """Pivots, each the vector that is farthest from the span of those before it, and what their distances tell."""

    def __init__(self, vectors: np.ndarray, most: int) -> None:
        left, chosen, basis, first = vectors.astype(float), [], [], 0.0
        while len(chosen) < min(most, vectors.shape[1], len(vectors)):
            far = (left * left).sum(axis=1)
            at = int(far.argmax())
            first = max(first, float(far[at]))
            if far[at] <= _APART**2 * first or not far[at]:
                break
            unit = left[at] / np.sqrt(far[at])
            chosen.append(at)
            basis.append(unit)
            left = left - np.outer(left @ unit, unit)
        self.vectors = vectors[chosen].astype(float)
        self.norms = (self.vectors**2).sum(axis=1)
        axes = np.array(basis).reshape(len(chosen), vectors.shape[1])
        self.back = np.linalg.inv(self.vectors @ axes.T) if chosen else np.zeros((0, 0))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.vectors) or vectors.shape[1] != self.vectors.shape[1]:
            return np.zeros((len(vectors), 0))
        return np.sqrt(np.maximum((vectors * vectors).sum(axis=1)[:, None] + self.norms - 2 * vectors @ self.vectors.T, 0))

    def places(self, distances: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the span of the pivots, and the distance from it."""
        if not distances.shape[1]:
            return np.zeros((len(distances), 0)), np.sqrt(norms)
        at = (norms[:, None] + self.norms - distances**2) / 2 @ self.back.T
        return at, np.sqrt(np.maximum(norms - (at * at).sum(axis=1), 0))


def bounds(q: tuple[np.ndarray, np.ndarray], c: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """[query, candidate]: the greatest inner product that their places allow."""
    return q[0] @ c[0].T + np.outer(q[1], c[1])


def choose_pivots(vectors: np.ndarray, k: int = K) -> Pivots:
    """As many as cost least: the share of candidates that must be evaluated among the vectors, times what that costs, plus the pivots."""
    if not len(vectors):
        return Pivots(vectors, 0)
    dim, some = vectors.shape[1], vectors[:TRIES]
    scores = some @ vectors.T
    scores[np.arange(len(some)), np.arange(len(some))] = -np.inf
    last = np.sort(scores, axis=1)[:, -min(k, len(vectors))]
    best = (float(dim), 0)
    norms = (vectors * vectors).sum(axis=1)
    for many in sorted({max(1, dim * step // 8) for step in range(1, 9)}):
        pivots = Pivots(vectors, many)
        at = pivots.places(pivots.distances(vectors), norms)
        share = float((bounds((at[0][: len(some)], at[1][: len(some)]), at) >= last[:, None]).mean())
        best = min(best, (many + share * dim, many))
    return Pivots(vectors, best[1])


def search(pivots: Pivots, q: np.ndarray, q_id: np.ndarray, q_far: np.ndarray, floor: np.ndarray, c: np.ndarray, c_id: np.ndarray, c_far: np.ndarray, k: int) -> tuple[list[int], list[int], list[int], int]:
    """query ids, candidate ids, scores of each query's k best that reach its floor, and how many products were evaluated. Vectors are whole numbers."""
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    qf, cf = q.astype(float), c.astype(float)
    whole = float(np.abs(qf).max(initial=0)) * float(np.abs(cf).max(initial=0)) * q.shape[1] < _EXACT
    exact = cf if whole else c.astype(object)
    q2, c2, evaluated = (qf * qf).sum(axis=1), (cf * cf).sum(axis=1), 0
    q_at, c_at = pivots.places(q_far, q2), pivots.places(c_far, c2)
    for start in range(0, len(q), 64):
        many = bounds((q_at[0][start : start + 64], q_at[1][start : start + 64]), c_at)
        for row, above in enumerate(many, start):
            query_id = int(q_id[row])
            above += 1 + 1e-7 * (q2[row] + c2)  # rounding never hides a candidate
            above[c_id == query_id] = -np.inf
            target = qf[row] if whole else q[row].astype(object)
            able = np.flatnonzero(above >= floor[row])
            order = able[np.argsort(-above[able], kind="stable")]
            at, step, best_score, best_id = 0, 4 * k, np.zeros(0), np.zeros(0, np.int64)
            while at < len(order) and above[order[at]] > -np.inf and (len(best_score) < k or above[order[at]] >= best_score[-1]):
                take = order[at : at + step]
                take = take[above[take] > -np.inf]
                scores = exact[take] @ target
                evaluated += len(take)
                best_score, best_id = np.append(best_score, scores), np.append(best_id, c_id[take])
                first = np.lexsort((best_id, -best_score))[:k] if whole else np.array(sorted(range(len(best_id)), key=lambda i: (-best_score[i], best_id[i]))[:k], int)
                best_score, best_id = best_score[first], best_id[first]
                at, step = at + step, step * 2
            out[0].extend([query_id] * len(best_id))
            out[1].extend(best_id.tolist())
            out[2].extend(int(s) for s in best_score)
    return *out, evaluated


def floors(q: np.ndarray, q_id: np.ndarray, sample: np.ndarray, sample_id: np.ndarray, k: int) -> np.ndarray:
    """A score that each query's k-th best row reaches at least: that among the sample."""
    if len(sample) <= k or q.shape[1] != sample.shape[1]:
        return np.full(len(q), -np.inf)
    scores = q.astype(float) @ sample.T.astype(float)
    scores[q_id[:, None] == sample_id[None, :]] = -np.inf
    found = np.partition(scores, -k, axis=1)[:, -k]
    return found - 1e-7 * np.abs(found) - 1


def top_k(df: DataFrame, k: int = K, every: int = EVERY, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, the k best of all other rows.

    Components become floor(scale * x). Vectors that are null or hold null or non-finite components, and rows without an
    id, take no part; an id that comes repeatedly counts once, with its least vector; vectors of different lengths aren't
    compared; equal scores go to the smaller id. The pivots come from SAMPLE vectors of least hash; every row is indexed.
    """
    spark = df.sparkSession
    ship_package(spark)
    bound_batches(spark)
    scaled = F.transform(vector, lambda v: F.floor(F.lit(scale) * v.cast("double")))
    rows = stash(df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), scaled.alias("v")).groupBy("id").agg(F.min("v").alias("v")).where(F.size("v") > 0))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    total = rows.count()
    dim = max((len(r["v"]) for r in sample), default=0)
    sample = [r for r in sample if len(r["v"]) == dim]
    vectors = np.array([r["v"] for r in sample], float).reshape(-1, max(dim, 1))
    known = spark.sparkContext.broadcast((choose_pivots(vectors, k), vectors, np.array([r["id"] for r in sample], np.int64)))
    fields = {"id": pa.int64(), "dim": pa.int32(), "v": pa.binary(), "far": pa.binary(), "floor": pa.float64()}

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, some, some_id = known.value
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = np.asarray(lists.value_lengths())
            starts = np.cumsum(sizes) - sizes
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():  # vectors of one length together
                at = np.flatnonzero(sizes == size)
                v = flat[starts[at][:, None] + np.arange(size)]
                far = pivots.distances(v.astype(float))
                floor = np.full(len(at), -np.inf)
                asks = ids[at] % every == 0
                floor[asks] = floors(v[asks], ids[at][asks], some, some_id, k)
                columns = [ids[at], np.full(len(at), size), [x.tobytes() for x in v], [x.tobytes() for x in far], floor]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, fields.values(), strict=True)], names=list(fields))

    indexed = stash(rows.mapInArrow(index, "id long, dim int, v binary, far binary, floor double"))
    blocks = lambda n, size: max(1, -(-n // size))
    n_q, n_c = blocks(total // every + 1, query_block), blocks(total, candidate_block)
    side = ["id", "v", "far", "floor"]
    q = indexed.where(F.col("id") % every == 0).select("dim", F.pmod(F.xxhash64("id"), F.lit(n_q).cast("long")).alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))).alias("cb"), *side)
    c = indexed.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))).alias("qb"), F.pmod(F.xxhash64("id"), F.lit(n_c).cast("long")).alias("cb"), *side)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        def arrays(t: pa.Table) -> tuple[Any, ...]:
            v, far = (np.frombuffer(b"".join(t[x].to_pylist()), kind).reshape(t.num_rows, -1) for x, kind in (("v", np.int64), ("far", float)))
            return v, t["id"].to_numpy(), far

        found: tuple = ([], [], [])
        if left.num_rows and right.num_rows:
            found = search(known.value[0], *arrays(left), left["floor"].to_numpy(), *arrays(right), k)[:3]
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])

    met = q.groupBy("dim", "qb", "cb").cogroup(c.groupBy("dim", "qb", "cb")).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
