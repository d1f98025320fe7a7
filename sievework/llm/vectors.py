"""Near duplicates among vectors of one label: pairs of at least a cosine, found by walking cover trees together.

Equal vectors of a label are merged first. Spark rounds deal the others out: cells of more than BLOCK vectors are divided
among centres that are chosen far apart, until each cell is a block that fits in a task, where a cover tree is built over
it (covertree.py). Cells are the upper nodes of the same tree: pairs of them are opened level by level, from the label's
root down, as joins of the nodes, and left as a whole where their balls are too far apart, or counted as a whole where
every two points are near enough. Only pairs of blocks that remain are brought together, each in a task of its own.
What leaves a task is a row for each linked vector: how many it links to, and one that it is linked with over others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.joins import join_one
from ..session import ship_package, stash
from .blocks import bound_batches
from .covertree import CLOSE, CoverTree, Joined, Side
from .pivots import usable

COSINE = 0.98
#: Vectors of a block, centres that a cell is divided among at most, and vectors (about) that they are chosen from.
BLOCK, FANOUT, CHOICE = 4_096, 64, 1_024
#: Rounds of dividing; cells that are still larger, as all their vectors have the same nearest centre, are cut by hash.
LEVELS = 12
_SPACE = 1 << 30


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.astype(float).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, initial=0)[:, None]  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = len(flat[0]) if len(flat) else 1
    return _unit(flat.flatten().to_numpy(zero_copy_only=False), size)


def _choose(sample: np.ndarray, many: int) -> np.ndarray:
    """Centres far apart: each the vector that is farthest from those before it; equal vectors are never both chosen."""
    chosen, best = [0], sample @ sample[0]
    while len(chosen) < many:
        at = int(best.argmin())
        if best[at] > 1 - CLOSE:
            break
        chosen.append(at)
        best = np.maximum(best, sample @ sample[at])
    return sample[chosen]


def _divide(points: DataFrame, block: int) -> DataFrame:
    """points (cid, n, v, cell, path) with cells of at most `block` rows as far as vectors can be told apart; path: the cells from the root."""
    before = None
    for _ in range(LEVELS):
        large = points.groupBy("cell").agg(F.count("*").alias("rows")).where(F.col("rows") > block)
        large = stash(large)
        state = large.agg(F.count("*").alias("n"), F.max("rows").alias("most"), F.sum("rows").alias("all")).first()
        if not state["n"] or state == before:
            break
        before = state
        share = F.least(F.lit(1.0), F.lit(float(CHOICE)) / F.col("rows"))
        drawn = points.join(large, "cell").where(F.pmod(F.xxhash64("cid", "cell"), F.lit(_SPACE)) <= share * _SPACE).select("cell", "rows", "v")

        def choose(table: pa.Table) -> pa.Table:
            x = _rows(table["v"])
            many = min(FANOUT, max(2, -(-2 * table["rows"][0].as_py() // block)))
            return pa.table({"cell": [table["cell"][0].as_py()], "centres": [_choose(x, many).tobytes()]})

        centres = drawn.groupBy("cell").applyInArrow(choose, "cell string, centres binary")
        wide = large.join(centres, "cell").select("cell", "centres", F.ceil(F.col("rows") / block).alias("subs"))
        wide = stash(wide.select("cell", "subs", "centres"))
        named = points.join(wide.select("cell", "subs"), "cell").withColumn("sub", F.pmod(F.xxhash64("cid"), F.col("subs")))
        parts = wide.select("cell", "centres", F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("sub"))

        def assign(rows: pa.Table, side: pa.Table) -> pa.Table:
            if not rows.num_rows or not side.num_rows:
                return pa.table({"cid": pa.array([], pa.int64()), "child": pa.array([], pa.int32())})
            x = _rows(rows["v"])
            c = np.frombuffer(side["centres"][0].as_py()).reshape(-1, x.shape[1])
            return pa.table({"cid": rows["cid"], "child": pa.array((x @ c.T).argmax(axis=1).astype(np.int32))})

        found = named.select("cell", "sub", "cid", "v").groupBy("cell", "sub").cogroup(parts.groupBy("cell", "sub")).applyInArrow(assign, "cid long, child int")
        name = F.when(F.col("child").isNull(), F.col("cell")).otherwise(F.concat_ws("/", "cell", "child"))
        points = points.join(found, "cid", "left").withColumn("_cell", name)
        points = stash(points.select("cid", "n", "v", F.col("_cell").alias("cell"), F.when(F.col("child").isNull(), F.col("path")).otherwise(F.concat("path", F.array("_cell"))).alias("path")))
    return points


def _blocks(points: DataFrame, block: int) -> DataFrame:
    """block, path (the nodes from the root down to the block), centre, radius, weight, rep, and the packed tree: cids, ns, points, nodes."""
    sizes = points.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("subs"))
    named = points.join(sizes, "cell").withColumn("block", F.concat_ws("#", "cell", F.pmod(F.xxhash64("cid"), F.col("subs")).cast("string")))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        x = _rows(table["v"])
        tree = CoverTree.over(x)
        cids, ns = (table[c].to_numpy()[tree.order] for c in ("cid", "n"))
        row = {"block": table["block"][0].as_py(), "path": table["path"][0].as_py() + [table["block"][0].as_py()], "centre": x[tree.order[0]].tolist(), "radius": float(tree.nodes[0][2]), "weight": int(ns.sum()), "rep": int(cids[0])}
        row |= {"cids": cids.tobytes(), "ns": ns.tobytes(), "points": x[tree.order].tobytes(), "nodes": tree.nodes.tobytes()}
        return pa.table({k: [v] for k, v in row.items()})

    return stash(named.select("block", "path", "cid", "n", "v").groupBy("block").applyInArrow(pack, "block string, path array<string>, centre array<double>, radius double, weight long, rep long, cids binary, ns binary, points binary, nodes binary"))


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _levels(blocks: DataFrame) -> list[DataFrame]:
    """For each level from the root: node, parent, centre, radius, weight, rep. Blocks nearer to the root stand in all levels below them."""
    depth = blocks.agg(F.max(F.size("path"))).first()[0] or 0
    at = lambda k: F.coalesce(F.try_element_at("path", F.lit(k + 1)), F.col("block"))
    chain = blocks.select("block", "centre", "radius", "weight", "rep", F.array(*map(at, range(depth))).alias("chain"))
    out: list[DataFrame] = []
    for k in reversed(range(depth)):
        node, parent = F.col("chain")[k], F.col("chain")[k - 1] if k else F.lit(None).cast("string")
        if not out:
            own = chain.select(node.alias("node"), parent.alias("parent"), "centre", "radius", "weight", "rep")
        else:
            child = out[-1]
            heads = child.groupBy("parent").agg(F.min_by(F.struct("centre", "rep"), "node").alias("_h"), F.sum("weight").alias("_w"))
            held = child.join(heads, "parent").groupBy("parent").agg(F.first("_h").alias("_h"), F.first("_w").alias("weight"), F.max(_distance(F.col("_h.centre"), F.col("centre")) + F.col("radius")).alias("radius"))
            up = chain.select(node.alias("node"), parent.alias("parent")).distinct()
            own = up.join(held.withColumnRenamed("parent", "node"), "node").select("node", "parent", "_h.centre", "radius", "weight", "_h.rep")
        out.append(stash(own))
    return out[::-1]


def _pairs(levels: list[DataFrame], far: float) -> tuple[DataFrame, DataFrame]:
    """Pairs a, b of blocks to look at, and pairs of nodes (x, y; a node with itself too) of which every two points are near enough."""
    roots = levels[0]
    now = roots.select(F.col("node").alias("a"), F.col("node").alias("b"))
    whole = []
    for at, level in enumerate(levels):
        side = lambda n: level.select(*(F.col(c).alias(f"{c}_{n}") for c in ("node", "parent", "centre", "radius", "weight", "rep")))  # noqa: B023, E731
        if at:
            met = now.join(side("a"), F.col("a") == F.col("parent_a")).join(side("b"), F.col("b") == F.col("parent_b")).where((F.col("a") < F.col("b")) | (F.col("node_a") <= F.col("node_b")))
        else:
            met = now.join(side("a"), F.col("a") == F.col("node_a")).join(side("b"), F.col("b") == F.col("node_b"))
        same = F.col("node_a") == F.col("node_b")
        apart = F.when(same, F.lit(0.0)).otherwise(_distance(F.col("centre_a"), F.col("centre_b")))
        reach = F.col("radius_a") + F.col("radius_b")
        met = met.withColumns({"_d": apart, "_r": reach}).where(F.col("_d") - F.col("_r") <= far + CLOSE)
        near = F.col("_d") + F.col("_r") <= far - CLOSE
        met = stash(met.withColumn("_near", near).select(*(f"{c}_{n}" for n in "ab" for c in ("node", "weight", "rep")), "_near"))
        whole.append(met.where("_near"))
        now = met.where(~F.col("_near")).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return now, reduce(DataFrame.unionByName, whole)


def _side(row: dict, x: str = "") -> tuple[Side, np.ndarray]:
    cids = np.frombuffer(row[f"cids{x}"], np.int64)
    return Side(np.frombuffer(row[f"points{x}"]).reshape(len(cids), -1), np.frombuffer(row[f"ns{x}"], np.int64), np.frombuffer(row[f"nodes{x}"]).reshape(-1, 5)), cids


_FOUND = "cid long, links long, root long"


def _found(cids: np.ndarray, links: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero((links > 0) | (roots != cids))
    return pa.RecordBatch.from_arrays([pa.array(x[at], pa.int64()) for x in (cids, links, roots)], names=["cid", "links", "root"])


def links(points: DataFrame, least: float = COSINE, block: int = BLOCK) -> DataFrame:
    """cid, links, root: what each task has found for a vector. Links add up to the weight of the vectors linked with; roots are linked with over others.

    points: cid (distinct), n (its weight), v (finite, not zero), cell (vectors of different cells aren't compared).
    """
    far = float(np.sqrt(max(2 - 2 * least, 0)))
    blocks = _blocks(_divide(points.withColumn("path", F.array("cell")), block), block)
    levels = _levels(blocks)
    if not levels:
        return points.sparkSession.createDataFrame([], _FOUND)
    pairs, whole = _pairs(levels, far)

    def alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                side, cids = _side(row)
                joined = Joined(side, None, least)
                yield _found(cids, joined.links, cids[joined.label])

    def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                (a, of_a), (b, of_b) = _side(row, "_a"), _side(row, "_b")
                joined, cids = Joined(a, b, least), np.concatenate([of_a, of_b])
                yield _found(cids, joined.links, cids[joined.label])

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cids, ns = np.frombuffer(row["cids"], np.int64), np.frombuffer(row["ns"], np.int64)
                yield _found(cids, row["more"] - row["own"] * ns, np.full(len(cids), row["root"]))

    packed = ("cids", "ns", "points", "nodes")
    own = blocks.join(pairs.where("a = b").select(F.col("a").alias("block")), "block").select(*packed)
    side = lambda n: blocks.select(F.col("block").alias(n), *(F.col(c).alias(f"{c}_{n}") for c in packed))
    met = pairs.where("a <> b").join(side("a"), "a").join(side("b"), "b").select(*(f"{c}_{n}" for n in "ab" for c in packed))
    met = met.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.rand(1))
    out = own.mapInArrow(alone, _FOUND).unionByName(met.mapInArrow(together, _FOUND))
    # what is counted as a whole: each node gets the weight of the others, and its points are linked with its own first one
    same = F.col("node_a") == F.col("node_b")
    one = whole.select(F.col("node_a").alias("node"), F.col("weight_b").alias("more"), same.cast("long").alias("own"), F.col("rep_a").alias("root"))
    two = whole.where(~same).select(F.col("node_b").alias("node"), F.col("weight_a").alias("more"), F.lit(0).cast("long").alias("own"), F.col("rep_b").alias("root"))
    per = one.unionByName(two).groupBy("node").agg(F.sum("more").alias("more"), F.sum("own").alias("own"), F.first("root").alias("root"))
    chain = blocks.select("block", F.explode("path").alias("node")).join(per, "node").select("block", "more", "own", "root")
    out = out.unionByName(blocks.join(chain, "block").select("cids", "ns", "more", "own", "root").mapInArrow(counted, _FOUND))
    return out.unionByName(whole.where(~same).select(F.col("rep_a").alias("cid"), F.lit(0).cast("long").alias("links"), F.col("rep_b").alias("root")))


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = COSINE, block: int = BLOCK) -> DataFrame:
    """key, n_links (other vectors of the same label at that cosine or more), component (the least key reachable), kept (key is that) for each row.

    Cosines are taken in double precision. Vectors that are null, empty, zero or hold null or non-finite components, and
    those without a label, link with nothing, nor do vectors of different lengths. Repeated rows link with each other.
    Rows with a null key link like others but name no component unless there is no other. An empty table gives no rows.
    """
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("v"))
    able = F.coalesce(F.col("label").isNotNull() & usable(F.col("v")) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = stash(rows.withColumn("able", able))
    merged = rows.where("able").groupBy("label", "v").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    classes = stash(merged.withColumns({"cid": F.monotonically_increasing_id(), "cell": F.to_json(F.struct("label", F.size("v").alias("dim")))}))
    found = stash(links(classes.select("cid", "n", "v", "cell"), least, block))
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    stars = components(found.where(F.col("cid") != F.col("root")), "cid", "root")
    joined = stash(classes.join(linked, "cid", "left").join(stars, F.col("cid") == F.col("node"), "left").select("label", "v", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root")))
    first = stash(joined.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("rows")))
    named = stash(join_one(joined, first, ["root"]).select("label", "v", (F.col("links") + F.col("n") - 1).alias("links"), "component", F.col("n").alias("rows")))
    alone = rows.where(~F.col("able")).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    out = join_one(rows.where("able").select("key", "label", "v"), named, ["label", "v"]).select("key", F.col("links").alias("n_links"), "component").unionByName(alone)
    return out.select(F.col("key").alias(key), "n_links", "component", F.col("key").eqNullSafe(F.col("component")).alias("kept"))
