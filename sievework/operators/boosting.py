"""Boosted trees for several tags at once, each tried on folds it hasn't seen.

Features are cut into bins by exact quantiles. All trees of a round, one for each tag and fold, grow together, level by
level: each task adds up the gradients of its rows by tree, node, feature and bin, one aggregation adds up the tasks', and
the driver picks the splits from these sums, whose number doesn't depend on the rows. Gradients are whole numbers, so sums
and trees are the same on any partitioning. Rows keep their margins in a written table, renewed every few rounds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, stash
from .order import running

FOLDS, ROUNDS, DEPTH, BINS, RATE, SMOOTH = 5, 12, 3, 32, 0.3, 1.0
#: Rounds after which margins are written, so that trees are walked no more often.
RENEW = 6
#: A gradient of one, as a whole number.
UNIT = 1 << 20


@dataclass
class Trees:
    """Trees of one round: feature (-1: all go left) and last bin to the left for [model, node], and values [model, leaf]."""

    feature: np.ndarray
    last: np.ndarray
    values: np.ndarray

    @classmethod
    def start(cls, models: int, depth: int) -> Trees:
        return cls(np.full((models, (1 << depth) - 1), -1), np.zeros((models, (1 << depth) - 1), np.int64), np.zeros((models, 1 << depth)))

    def place(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """[row, model]: the row's node of that level, counted from 0 in the level."""
        rows, models = np.arange(len(bins))[:, None], np.arange(len(self.feature))
        at = np.zeros((len(bins), len(models)), np.int64)
        for level in range(levels):
            node = (1 << level) - 1 + at
            feature = self.feature[models, node]
            at = 2 * at + ((feature >= 0) & (bins[rows, np.maximum(feature, 0)] > self.last[models, node]))
        return at

    def add(self, margins: np.ndarray, bins: np.ndarray) -> np.ndarray:
        depth = self.values.shape[1].bit_length() - 1
        return margins + self.values[np.arange(len(self.values)), self.place(bins, depth)]


def grow(trees: Trees, level: int, sums: np.ndarray, rate: float = RATE, smooth: float = SMOOTH) -> None:
    """Split the nodes of a level by [model, node, feature, bin, (gradient, curvature)]; the last level's splits give the leaves."""
    g, h = sums[..., 0].astype(float) / UNIT, sums[..., 1].astype(float) / UNIT
    score = lambda g, h: g * g / (h + smooth)
    left_g, left_h = g.cumsum(axis=-1), h.cumsum(axis=-1)
    all_g, all_h = left_g[:, :, :1, -1:], left_h[:, :, :1, -1:]
    gain = score(left_g, left_h) + score(all_g - left_g, all_h - left_h) - score(all_g, all_h)
    gain[(left_h <= 0) | (all_h - left_h <= 0)] = -1
    flat = gain.reshape(*gain.shape[:2], -1)
    best, bins = flat.argmax(axis=-1), gain.shape[-1]
    for model, node in np.ndindex(*best.shape):
        k = best[model, node]
        f, b = divmod(int(k), bins)
        splits = flat[model, node, k] > 1e-9
        at = (1 << level) - 1 + node
        trees.feature[model, at], trees.last[model, at] = (f, b) if splits else (-1, 0)
        if at >= trees.feature.shape[1] // 2:
            ends = [(left_g[model, node, f, b], left_h[model, node, f, b])] if splits else [(all_g[model, node, 0, 0], all_h[model, node, 0, 0])]
            ends.append((all_g[model, node, 0, 0] - ends[0][0], all_h[model, node, 0, 0] - ends[0][1]))
            for side, (gs, hs) in enumerate(ends):
                trees.values[model, 2 * node + side] = -rate * gs / (hs + smooth)


def gradients(labels: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the logistic loss, as whole numbers."""
    p = 1 / (1 + np.exp(-margins))
    return np.rint((p - labels) * UNIT).astype(np.int64), np.rint(p * (1 - p) * UNIT).astype(np.int64)


def edges(rows: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """For each feature the values that end its bins: those at equal shares of all its values."""
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.col(x).cast("double").alias("v")) for i, x in enumerate(features)))).alias("x")).select("x.f", "x.v")
    counted = long.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("f", "v").agg(F.count("*").alias("n"))
    placed = stash(running(counted, ["f"], [F.col("v")], {"upto": F.col("n")}))
    total = placed.groupBy("f").agg(F.max("upto").alias("total"))
    share = F.floor((F.col("upto") - 1) * (bins - 1) / F.col("total"))
    out: list[list[float]] = [[] for _ in features]
    for r in placed.join(F.broadcast(total), "f").groupBy("f", share.alias("bin")).agg(F.max("v").alias("v")).collect():  # bins of each feature
        out[r["f"]].append(r["v"])
    return [sorted(x) for x in out]


def cross_scores(rows: DataFrame, key: str, features: list[str], tags: list[str], fold: Column, folds: int = FOLDS, rounds: int = ROUNDS, depth: int = DEPTH, bins: int = BINS) -> DataFrame:
    """key, fold, tag, label, score: the share that trees fitted on the other folds give each labelled row.

    Labels are 0 or 1; rows whose label is null take no part for that tag. Null and not-a-number features have a bin of
    their own, below the others. Repeated rows count each; a tag without both labels in the other folds has a constant score.
    """
    ship_package(rows.sparkSession)
    cuts = edges(rows, features, bins)
    models, wide = folds * len(tags), bins + 1
    of_fold, of_tag = np.repeat(np.arange(folds), len(tags)), np.tile(np.arange(len(tags)), folds)
    kind = rows.schema[key].dataType
    given = rows.select(F.col(key).alias("key"), fold.cast("int").alias("fold"), F.array(*(F.coalesce(F.col(t).cast("int"), F.lit(-1)) for t in tags)).alias("y"), F.array(*(F.col(x).cast("double") for x in features)).alias("x"))
    schema = f"key {kind.simpleString()}, fold int, y binary, bins binary, margins binary"

    def packed(batch: pa.RecordBatch, y: np.ndarray, b: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        binary = lambda a: pa.array([x.tobytes() for x in a], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("fold"), binary(y.astype(np.int8)), binary(b.astype(np.uint8)), binary(m.astype(float))], names=["key", "fold", "y", "bins", "margins"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(features))
            b = np.stack([np.where(np.isnan(v), 0, 1 + np.searchsorted(c, v)) for v, c in zip(x.T, cuts, strict=True)], axis=1)
            b = np.minimum(b, wide - 1)
            yield packed(batch, np.array(batch.column("y").to_pylist()).reshape(-1, len(tags)), b, np.zeros((len(b), models)))

    def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        read = lambda c, t, n: np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(-1, n)
        return batch.column("fold").to_numpy(zero_copy_only=False), read("y", np.int8, len(tags)), read("bins", np.uint8, len(features)), read("margins", float, models)

    def renewed(done: list[Trees]):  # type: ignore[no-untyped-def]
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, y, b, m = arrays(batch)
                for t in done:
                    m = t.add(m, b)
                yield packed(batch, y, b, m)

        return run

    def sums(done: list[Trees], now: Trees, level: int):  # type: ignore[no-untyped-def]
        nodes = 1 << level

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, models * nodes * len(features) * wide), np.int64)
            for batch in batches:
                own, y, b, m = arrays(batch)
                for t in done:
                    m = t.add(m, b)
                node = now.place(b, level)
                g, h = gradients(y[:, of_tag], m)
                for model in range(models):
                    use = (own != of_fold[model]) & (y[:, of_tag[model]] >= 0)
                    at = ((model * nodes + node[use, model])[:, None] * len(features) + np.arange(len(features))) * wide + b[use]
                    for k, v in enumerate((g, h)):
                        total[k] += np.bincount(at.ravel(), np.repeat(v[use, model], len(features)), total.shape[1]).astype(np.int64)
            at = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["at", "g", "h"])

        return run

    state, done = stash(given.mapInArrow(cut, schema)), []
    for at in range(rounds):
        now = Trees.start(models, depth)
        for level in range(depth):
            held = np.zeros((models * (1 << level) * len(features) * wide, 2), np.int64)
            for r in state.mapInArrow(sums(done, now, level), "at long, g long, h long").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():  # a number for each bin of a node
                held[r["at"]] = r["g"], r["h"]
            grow(now, level, held.reshape(models, 1 << level, len(features), wide, 2))
        done.append(now)
        if (at + 1) % RENEW == 0 or at == rounds - 1:
            state, done = stash(state.mapInArrow(renewed(done), schema)), []

    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, y, _, m = arrays(batch)
            for tag in range(len(tags)):
                model = np.clip(own, 0, folds - 1) * len(tags) + tag
                use = np.flatnonzero(y[:, tag] >= 0)
                margin = m[use, model[use]]
                columns = [batch.column("key").take(pa.array(use)), batch.column("fold").take(pa.array(use)), pa.array([tags[tag]] * len(use), pa.string()), pa.array(y[use, tag].astype(np.int32)), pa.array(1 / (1 + np.exp(-margin)))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "fold", "tag", "label", "score"])

    return state.mapInArrow(scores, f"key {kind.simpleString()}, fold int, tag string, label int, score double").withColumnRenamed("key", key)


def rank_measure(scored: DataFrame, group: list[str], score: str, label: str) -> DataFrame:
    """group, n, positives, auc: how often a positive row scores above a negative one, ties half; null without both. Groups may have any size."""
    counted = scored.groupBy(*group, score).agg(F.sum(F.col(label).cast("long")).alias("_pos"), F.sum((1 - F.col(label)).cast("long")).alias("_neg"))
    along = running(counted, group, [F.col(score)], {"_upto": F.col("_neg")})
    won = F.col("_pos").cast("decimal(38,1)") * (2 * (F.col("_upto") - F.col("_neg")) + F.col("_neg"))
    out = along.groupBy(*group).agg(F.sum(F.col("_pos") + F.col("_neg")).alias("n"), F.sum("_pos").alias("positives"), F.sum("_neg").alias("_all_neg"), F.sum(won).alias("_won"))
    return out.select(*group, "n", "positives", F.try_divide(F.col("_won").cast("double"), (2 * F.col("positives") * F.col("_all_neg")).cast("double")).alias("auc"))
