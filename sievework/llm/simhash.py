"""SimHash near-duplicates by the generalised pigeonhole principle.

Equal fingerprints are merged first. Counts of bits over all distinct fingerprints decide how the 64 bits are grouped
and how near each group must be (pigeonhole.py). Every fingerprint then goes to the buckets of its group values and of
the values near them; in each bucket the fingerprints are verified, and only the links of a spanning forest leave it.
Buckets beyond BUCKET rows are cut into blocks, and each pair of blocks is worked on by itself, so no bucket has to fit
in a task and no link is lost. Components of the links give the groups.

Dropping near copies (keep_one) takes a similarity: the fingerprints of five-word shingles may then differ in more bits,
and each link must be borne out by sketches, the least hashes of both texts' shingles. Buckets with few links emit every
one, to be verified afterwards; those with many fetch the sketches of their rows and emit a spanning forest of links that
hold by distance and similarity both. Either way what is joined is what all links that hold join, at any size of blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.joins import join_one
from ..session import small_side, stash
from .blocks import map_blocks
from .pigeonhole import BITS, Group, divide, forest, masks_of, near_pairs

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Of keep_one: words in a shingle, the similarity (Jaccard) that near copies have at least, and bits in which their fingerprints may differ.
COPY_SHINGLE, COPY_SIMILARITY, COPY_DISTANCE = 5, 0.8, 10
#: Least hashes that a sketch holds. Texts of no more shingles are compared exactly; others to about 0.025.
SKETCH = 256
#: Fingerprints by which candidate counts are estimated when bits are dealt into groups; those of least hash.
SAMPLE = 2_048
#: Pairs that a bucket emits for each of its rows when links are verified afterwards; denser ones fetch sketches and emit verified forests.
DENSE = 8
#: Rows of a bucket up to which it stays whole.
BUCKET = 4_096
#: Dropped documents up to which their ids are broadcast; beyond, texts are shuffled to meet them.
BROADCAST_IDS = 1_000_000
#: Up to this size buckets are compared all at once, shifted against themselves.
SMALL = 48


def text_fingerprints(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints as unsigned 64-bit integers. A-Z are lowered (in UTF-8, no other byte changes); words are split at ASCII white space."""
    return _read(texts, shingle)[0]


def _read(texts: list[str], shingle: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Fingerprints, and the hashes of the shingles of each text."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for at, text in enumerate(texts):
        words = text.encode().lower().split()
        if len(words) > shingle:
            own = [digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)), strict=False)]
        else:
            own = [digest(b" ".join(words), SEED)] if words else []
        hashes += own
        counts[at] = len(own)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    every = np.array(hashes, np.uint64)
    if len(full):
        bits = np.unpackbits(every.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.uint32)
        out[full] = np.packbits(2 * ones > counts[full][:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out, np.split(every, np.cumsum(counts)[:-1]) if len(texts) else []


def sketch(hashes: np.ndarray) -> bytes:
    """The least distinct hashes, cut to 32 bits, in order."""
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))[:SKETCH].tobytes()


def resemblance(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two texts' shingles by their sketches; exact if neither sketch is full. Two empty ones are equal."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = np.union1d(x, y)
    if len(x) == SKETCH or len(y) == SKETCH:
        both = both[:SKETCH]
    return len(np.intersect1d(np.intersect1d(x, y, True), both, True)) / len(both) if len(both) else 1.0


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, sketches: bool = False) -> DataFrame:
    """key, fp (the fingerprint as a signed long), text_hash and, if asked for, sketch for each row. A null text has no words and fingerprint zero."""

    def make() -> Any:
        def work(keys: list, texts: list[str], hashes: list[int]) -> list:
            fps, own = _read(texts, shingle)
            return [keys, fps.view(np.int64), hashes, *([list(map(sketch, own))] if sketches else [])]

        return work

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return map_blocks(rows, make, f"key {kind}, fp long, text_hash long" + (", sketch binary" if sketches else "")).withColumnRenamed("key", key)


def _counts(fps: DataFrame) -> tuple[np.ndarray, int]:
    """How many fingerprints have each two bits, and how many there are; each task sums its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            words = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += x.T @ x
            n += len(words)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["at", "n"])

    out = np.zeros(BITS * BITS + 1, np.int64)
    for r in fps.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 4,097 rows
        out[r["at"]] = r["n"]
    return out[:-1].reshape(BITS, BITS), int(out[-1])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _buckets(fps: DataFrame, groups: tuple[Group, ...]) -> DataFrame:
    """part, key, fp, own: a row for each value that a fingerprint has (its own) or is near to, in each group."""
    keys = []
    for at, group in enumerate(groups):
        own = F.col("fp").bitwiseAND(F.lit(_signed(masks_of(group.bits))))
        keys += [F.struct(F.lit(at).alias("part"), own.bitwiseXOR(F.lit(_signed(mask))).alias("key"), F.lit(int(mask == 0)).alias("own")) for mask in group.masks()]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.part", "k.key", "fp", "k.own")


_BUCKET = ("part", "key", "block")


def _verify(rows: DataFrame, distance: int, every: bool) -> DataFrame:
    """Links a, b of a spanning forest of each bucket, or every one if it isn't dense; rows of a bucket must be together and in order.

    Where every link is asked for, dense buckets give their members as a, with part, key and block, instead.
    """

    def links(words: np.ndarray, mine: np.ndarray, cuts: np.ndarray) -> tuple[list[int], list[int], list[int]]:
        a: list[int] = []
        b: list[int] = []
        dense: list[int] = []
        sizes = np.diff(cuts)
        top: dict[int, int] = {}

        def joins(x: int, y: int) -> bool:
            p, q = root(x), root(y)
            if p != q:
                top[max(p, q)] = min(p, q)
            return p != q

        def root(x: int) -> int:
            while (y := top.get(x, x)) != x:
                top[x] = top.get(y, y)
                x = y
            return x

        for k in np.flatnonzero(sizes > SMALL).tolist():
            own = words[cuts[k] : cuts[k + 1]]
            x, y, degree, whole = near_pairs(own, mine[cuts[k] : cuts[k + 1]] > 0, distance, DENSE * len(own))
            if not whole and every:
                dense.append(k)
                continue
            if not whole:  # what is near to most comes first, so that it is the others' link
                order = np.argsort(-degree, kind="stable")
                tree = forest(own[order], distance)
                x, y = order[[p for p, _ in tree]], order[[q for _, q in tree]]
            elif not every:
                top.clear()
                tree = [(p, q) for p, q in zip(x.tolist(), y.tolist(), strict=True) if joins(p, q)]
                x, y = np.array([p for p, _ in tree], np.int64), np.array([q for _, q in tree], np.int64)
            a.extend(own[x].tolist())
            b.extend(own[y].tolist())
        top.clear()
        bucket = np.repeat(np.arange(len(sizes)), sizes)
        bucket[np.repeat(sizes > SMALL, sizes)] = -1
        small = sizes[sizes <= SMALL]
        for shift in range(1, int(small.max()) if len(small) else 0):
            same = (bucket[shift:] == bucket[:-shift]) & (bucket[shift:] >= 0)
            at = np.flatnonzero(same)
            at = at[np.bitwise_count(words[at] ^ words[at + shift]) <= distance]
            for x in at.tolist():
                if every or joins(x, x + shift):
                    a.append(int(words[x]))
                    b.append(int(words[x + shift]))
        return a, b, dense

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], [], []]

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            part, key, block, words, own = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in held)
            fresh = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            end = len(words) if final else int(fresh[-1]) if len(fresh) else 0
            cuts = np.concatenate([[0], fresh[fresh < end], [end]]) if end else np.zeros(1, np.int64)
            a, b, dense = links(words[:end].view(np.uint64), own[:end], cuts)
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([signed(a), signed(b), none.cast(pa.int32()), none, none], names=["a", "b", *_BUCKET])
            for k in dense:
                of = slice(int(cuts[k]), int(cuts[k + 1]))
                members = pa.array(words[of])
                yield pa.RecordBatch.from_arrays([members, pa.nulls(len(members), pa.int64()), pa.array(part[of].astype(np.int32)), pa.array(key[of]), pa.array(block[of])], names=["a", "b", *_BUCKET])
            for at, x in enumerate((part, key, block, words, own)):
                held[at] = [x[end:]]

        for batch in batches:
            for at in range(5):
                held[at].append(batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64, copy=False))
            yield from flush(False)
        yield from flush(True)

    return rows.mapInArrow(run, "a long, b long, part int, key long, block long")


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, every: bool = False) -> DataFrame:
    """Links a, b between distinct fingerprints that differ in at most so many bits: enough of them to keep every group together, or every one.

    Of every one, those of dense buckets aren't spelt out: these give their members as a, with part, key and block.
    """
    counts, n = _counts(fps)
    sample = np.array([r["fp"] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").collect()], np.int64).view(np.uint64)
    rows = _buckets(fps, divide(counts, n, distance, sample))
    many = rows.groupBy("part", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > bucket)
    cut = rows.join(many, ["part", "key"], "left").withColumn("blocks", F.coalesce(F.ceil(F.col("rows") / bucket), F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    cut = cut.select("part", "key", "fp", F.col("own").alias("mine"), own.alias("own"), other.alias("other"))
    cut = cut.select("part", "key", (F.least("own", "other") * F.lit(1 << 31) + F.greatest("own", "other")).alias("block"), "fp", "mine")
    return _verify(cut.repartition("part", "key", "block").sortWithinPartitions("part", "key", "block", "fp"), distance, every)


def verified_forest(words: np.ndarray, sketches: list[bytes], distance: int, least: float) -> list[tuple[int, int]]:
    """Links between rows that hold by distance and similarity, and join what all such links join.

    Each reached row is compared with those not yet reached. How many hashes it shares with each of them is read from
    postings; where a full sketch says that not all shared ones count, the two sketches are compared themselves.
    """
    rows = [np.frombuffer(x, np.uint32) for x in sketches]
    sizes = np.array([len(r) for r in rows])
    _, code = np.unique(np.concatenate(rows) if len(rows) else np.zeros(0, np.uint32), return_inverse=True)
    codes = np.split(code, np.cumsum(sizes)[:-1]) if len(rows) else []
    order = np.argsort(code, kind="stable")
    posted = np.repeat(np.arange(len(rows)), sizes)[order]
    cuts = np.searchsorted(code[order], np.arange(int(code.max(initial=-1)) + 2))

    def alike(at: int, near: np.ndarray) -> np.ndarray:
        held = [posted[cuts[c] : cuts[c + 1]] for c in codes[at].tolist()]
        shared = np.bincount(np.concatenate(held), minlength=len(rows))[near] if held else np.zeros(len(near), np.int64)
        union = sizes[at] + sizes[near] - shared
        full = (sizes[near] == SKETCH) | (sizes[at] == SKETCH)
        good = np.where(union > 0, shared / np.maximum(union, 1), 1.0) >= least
        for k in np.flatnonzero(full).tolist():
            good[k] = shared[k] >= least * SKETCH and resemblance(sketches[at], sketches[near[k]]) >= least
        return near[good]

    out: list[tuple[int, int]] = []
    waiting = np.ones(len(words), bool)
    while waiting.any():
        frontier = [int(np.argmax(waiting))]
        waiting[frontier] = False
        while frontier and waiting.any():
            at = frontier.pop()
            near = np.flatnonzero(waiting & (np.bitwise_count(words ^ words[at]) <= distance))
            reached = alike(at, near) if len(near) else near
            waiting[reached] = False
            out += [(at, x) for x in reached.tolist()]
            frontier += reached.tolist()
    return out


def _similar(found: DataFrame, own: DataFrame, distance: int, least: float) -> DataFrame:
    """The links whose texts are similar enough by their sketches, those of dense buckets as forests."""
    found = stash(found)
    dense = found.where(F.col("part").isNotNull()).select(F.col("a").alias("fp"), *_BUCKET)
    spelt = stash(found.where(F.col("part").isNull()).select("a", "b").distinct())
    sketches = own.groupBy("fp").agg(F.min("sketch").alias("sketch"))
    ends = [spelt.select(F.col(x).alias("fp")).groupBy("fp").agg(F.count("*").alias(f"n_{x}")) for x in ("a", "b")]
    needed = ends[0].join(ends[1], "fp", "outer").join(dense.groupBy("fp").agg(F.count("*").alias("n_dense")), "fp", "outer")
    held = stash(sketches.join(small_side(needed, BROADCAST_IDS), "fp"))
    pairs = spelt
    for x in ("a", "b"):
        side = held.where(F.col(f"n_{x}").isNotNull()).select(F.col("fp").alias(x), F.col("sketch").alias(f"sketch_{x}"), F.col(f"n_{x}").alias("rows"))
        pairs = join_one(pairs, side, [x]).drop("rows")

    def make() -> Any:
        def work(a: list[int], b: list[int], of_a: list[bytes], of_b: list[bytes]) -> list:
            near = [i for i in range(len(a)) if resemblance(of_a[i], of_b[i]) >= least]
            return [[a[i] for i in near], [b[i] for i in near]]

        return work

    def grown(table: pa.Table) -> pa.Table:
        table = table.sort_by("fp")
        fps = table["fp"].to_numpy()
        tree = verified_forest(fps.view(np.uint64), table["sketch"].to_pylist(), distance, least)
        return pa.table({x: pa.array([int(fps[pair[at]]) for pair in tree], pa.int64()) for at, x in enumerate("ab")})

    checked = map_blocks(pairs.select("a", "b", "sketch_a", "sketch_b"), make, "a long, b long", None)
    if not dense.limit(1).count():
        return checked
    met = join_one(dense, held.where("n_dense is not null").select("fp", "sketch", F.col("n_dense").alias("rows")), ["fp"]).select(*_BUCKET, "fp", "sketch")
    return checked.unionByName(met.groupBy(*_BUCKET).applyInArrow(grown, "a long, b long"))


def _grouped(own: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """The rows of own with kept: none (whether the key is null), key and text_hash of the first row of their group."""
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "text_hash")
    fps = own.groupBy("fp").agg(F.min(place).alias("rep"), F.count("*").alias("rows"))
    stars = components(found)
    joined = stash(fps.join(stars, fps["fp"] == stars["node"], "left").select("fp", "rep", F.col("rows").alias("rows_of_fp"), F.coalesce("root", "fp").alias("root")))
    least = stash(joined.groupBy("root").agg(F.min("rep").alias("kept"), F.count("*").alias("rows")))
    labels = stash(join_one(joined, least, ["root"]).select("fp", "kept", F.col("rows_of_fp").alias("rows")))
    return join_one(own, labels, ["fp"]).drop("rows")


def group(df: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """key, fp, component (the least key that can be reached over links) for each row.

    Equal fingerprints always link, those of empty and null texts (zero) like any others. Null keys are grouped but name
    no component unless there is no other; repeated rows stay; an empty table gives no rows.
    """
    own = stash(fingerprints(df, key, text, shingle))
    found = links(stash(own.select("fp").distinct()), distance, bucket)
    return _grouped(own, key, found).select(key, "fp", F.col("kept.key").alias("component"))


def keep_one(docs: DataFrame, distance: int = COPY_DISTANCE, shingle: int = COPY_SHINGLE, similarity: float = COPY_SIMILARITY, bucket: int = BUCKET) -> DataFrame:
    """Of each group of near copies one row, with all its columns.

    Two texts link if their fingerprints are equal, or differ in at most `distance` bits and their shingles' Jaccard
    similarity is `similarity` or more. The row that stays has the least doc_id (a null one only where there is no other),
    of these the least hash of its text, of equal rows the least in all its columns: rows that share a doc_id but not a
    text are judged apart, and repeated rows stay once. Texts without words are alike. An empty table gives no rows.
    """
    own = stash(fingerprints(docs, shingle=shingle, sketches=True))
    found = _similar(links(stash(own.select("fp").distinct()), distance, bucket, every=True), own, distance, similarity)
    judged = stash(_grouped(own.drop("sketch"), "doc_id", found).groupBy("doc_id", "text_hash").agg(F.first("kept").alias("kept"), F.count("*").alias("rows")))
    stays = (F.col("text_hash") == F.col("kept.text_hash")) & F.col("doc_id").eqNullSafe(F.col("kept.key"))
    pair = (F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    dropped = small_side(judged.where(~stays).select(*pair), BROADCAST_IDS)
    repeated = small_side(judged.where(stays & (F.col("rows") > 1)).select(*pair), BROADCAST_IDS)

    def meets(rows: DataFrame, side: DataFrame) -> Column:
        return rows["doc_id"].eqNullSafe(side["_kept_id"]) & (F.xxhash64(rows["text"]) == side["_kept_hash"])

    left = docs.join(dropped, meets(docs, dropped), "left_anti")
    if not repeated.limit(1).count():
        return left
    again = left.join(repeated, meets(left, repeated), "left_semi")
    once = again.groupBy("doc_id", F.xxhash64("text")).agg(F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("_row"))
    return left.join(repeated, meets(left, repeated), "left_anti").unionByName(once.select("_row.*"))
