"""Product quantisation of vectors by Lloyd rounds that look again only at parts whose place may have changed.

Vectors are cut into equal parts, and each part position has a codebook. A part keeps how much farther its second nearest
entry is than its own (its slack). When entries move, a part's own entry comes no farther than it moved, and no other
comes nearer than the farthest move of the others; the sum of both, added up over the rounds, is the entry's drift. Each
block of rows has a heap for each entry of each position, its parts ordered by slack plus the drift when they came:
those whose key the drift has reached are popped, compared with all entries exactly, and pushed again; the others are
where they must be. Blocks are written after every round; what leaves a round are sums and counts for each entry.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType

from ..session import ship_package, small_side, stash
from .blocks import bound_batches
from .pivots import usable

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows that share heaps.
BLOCK = 8_192
#: Labels up to which their sums are broadcast.
BROADCAST_LABELS = 1_000_000
#: Components up to this size have distances that are exact in doubles; larger ones are compared as Python integers.
_EXACT = 1 << 22
#: Rounding that a bound may have; parts so close to it are compared again.
_CLOSE = 1e-6
_MOST = (1 << 63) - 1

#: [part, entry, component] as Python integers.
Books = list[list[list[int]]]


def _whole(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x and the book in a type in which squared distances are exact."""
    most = max((int(np.abs(a).max(initial=0)) for a in (x, book)), default=0)
    kind = float if most <= _EXACT and x.shape[1] <= 1 << 6 else object
    return x.astype(kind), book.astype(kind)


def scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row its nearest entry (the lower index of equals), the squared distance, and how much farther the second nearest is."""
    a, b = _whole(x, book)
    far = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    best = far.argmin(axis=1)
    rows = np.arange(len(x))
    least = far[rows, best]
    if len(book) == 1:
        return best, least, np.full(len(x), np.inf)
    far[rows, best] = far.max(initial=0) + 1
    second = far.min(axis=1)
    return best, least, np.sqrt(second.astype(float)) - np.sqrt(least.astype(float))


@dataclass
class Block:
    """Rows with the entries of their parts, and a heap (key, row) for each entry of each part position."""

    x: np.ndarray  # [row, part, component]
    codes: np.ndarray  # [row, part]
    heaps: list[list[list[tuple[float, int]]]]
    moved: np.ndarray = field(init=False)  # [part, entry, component sums and the count], since the last round
    compared: int = 0

    @classmethod
    def first(cls, x: np.ndarray, books: Books) -> Block:
        """Every part is compared with all entries."""
        entries = len(books[0])
        block = cls(x, np.zeros(x.shape[:2], np.uint8), [[[] for _ in range(entries)] for _ in books])
        block._start()
        rows = np.arange(len(x))
        for part, book in enumerate(books):
            block.codes[:, part], _, slack = scan(x[:, part], np.array(book, object))
            block._count(part, rows, 1)
            order = np.lexsort((slack, block.codes[:, part]))  # sorted is a heap
            items = list(zip(slack[order].tolist(), order.tolist(), strict=True))
            ends = np.searchsorted(block.codes[order, part], np.arange(entries), "right").tolist()
            block.heaps[part] = [items[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return block

    def _start(self) -> None:
        self.moved = np.zeros((len(self.heaps), len(self.heaps[0]), self.x.shape[2] + 1), object)

    def _count(self, part: int, rows: np.ndarray, sign: int) -> None:
        """Add the rows to the sums of their entries, or take them out."""
        codes, entries = self.codes[rows, part].astype(np.int64), self.moved.shape[1]
        own = self.x[rows, part]
        if int(np.abs(own).max(initial=0)) <= _EXACT:  # sums of a block are exact in doubles
            sums = np.stack([np.bincount(codes, weights=w, minlength=entries) for w in (*own.T, np.ones(len(rows)))], axis=1).astype(np.int64).astype(object)
        else:
            sums = np.zeros(self.moved.shape[1:], object)
            np.add.at(sums, codes, np.column_stack([own.astype(object), np.ones(len(rows), object)]))
        self.moved[part] += sign * sums

    def again(self, books: Books, drift: list[list[float]]) -> None:
        """Pop what the drift has reached and compare it anew."""
        self._start()
        for part, book in enumerate(books):
            popped: list[int] = []
            for entry, heap in enumerate(self.heaps[part]):
                reached = drift[part][entry] + _CLOSE
                while heap and heap[0][0] <= reached:
                    popped.append(heapq.heappop(heap)[1])
            if not popped:
                continue
            rows = np.array(popped)
            self.compared += len(rows)
            self._count(part, rows, -1)
            best, _, slack = scan(self.x[rows, part], np.array(book, object))
            self.codes[rows, part] = best
            self._count(part, rows, 1)
            heaps = self.heaps[part]
            for row, entry, far in zip(popped, best.tolist(), slack.tolist(), strict=True):
                heapq.heappush(heaps[entry], (far + drift[part][entry], row))

    def errors(self, books: Books) -> list[int]:
        """Squared distances of the rows' parts to their entries, added up for each row."""
        total: np.ndarray = np.zeros(len(self.x), object)
        for part, book in enumerate(books):
            a, b = _whole(self.x[:, part], np.array(book, object))
            total = total + ((a - b[self.codes[:, part]]) ** 2).sum(axis=1)
        return [min(int(t), _MOST) for t in total.tolist()]


def _pack(block: Block) -> dict[str, bytes | str]:
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= block.x.min(initial=0) and block.x.max(initial=0) <= np.iinfo(k).max)
    flat = [item for heaps in block.heaps for heap in heaps for item in heap]
    return {
        "kind": kind,
        "x": block.x.astype(kind).tobytes(),
        "codes": block.codes.tobytes(),
        "sizes": np.array([len(h) for heaps in block.heaps for h in heaps], "<i4").tobytes(),
        "keys": np.array([k for k, _ in flat], float).tobytes(),
        "rows": np.array([r for _, r in flat], "<u2").tobytes(),
    }


def _unpack(row: dict, parts: int, entries: int) -> Block:
    codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, parts).copy()
    x = np.frombuffer(row["x"], row["kind"]).reshape(len(codes), parts, -1).astype(np.int64)
    items = list(zip(np.frombuffer(row["keys"]).tolist(), np.frombuffer(row["rows"], "<u2").tolist(), strict=True))
    ends = np.cumsum(np.frombuffer(row["sizes"], "<i4")).tolist()
    heaps = [items[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    return Block(x, codes, [heaps[p * entries : (p + 1) * entries] for p in range(parts)])


def _moves(old: Books, new: Books, drift: list[list[float]]) -> list[list[float]]:
    """The drift of each entry after it, and the others of its position, have moved once more."""
    out = []
    for was, now, before in zip(old, new, drift, strict=True):
        far = [float(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))) ** 0.5 for x, y in zip(was, now, strict=True)]
        top = sorted(far, reverse=True) + [0.0, 0.0]
        out.append([d + f + (top[1] if f == top[0] else top[0]) for d, f in zip(before, far, strict=True)])
    return out


def quantise(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK) -> tuple[DataFrame, Books]:
    """key, label, codes (one byte for each part), error, label_error for each row, and the codebooks.

    Components become floor(scale * x). Each codebook starts as that part of the `entries` rows of least key (null keys
    last, of equal keys the lesser vector). Rows whose vector is null, empty or holds null or non-finite components are
    dropped, as are those of another length than the first of these; a length that isn't a multiple of `parts` is filled
    up with zeros. Repeated rows stay, and count each; null labels are one label. Errors beyond 2^63 - 1 are that. A
    table without usable rows gives none and empty codebooks.
    """
    if not 1 <= entries <= 256 or not 1 <= block <= 1 << 16:
        raise ValueError("entries are 1 to 256, rows of a block 1 to 65,536")
    spark = df.sparkSession
    ship_package(spark)
    bound_batches(spark)
    whole = F.transform(vector, lambda v: F.floor(F.lit(scale) * v.cast("double")))
    rows = df.where(usable(F.col(vector)) & (F.size(vector) > 0)).select(F.col(key).alias("key"), F.col(label).alias("label"), whole.alias("v"))
    order = [F.col("key").asc_nulls_last(), F.col("v")]
    start = [r["v"] for r in rows.orderBy(*order).limit(1).collect()]
    dim = len(start[0]) if start else parts
    rows = rows.where(F.size("v") == dim)
    width = -(-dim // parts)
    filled = [[*r["v"], *[0] * (width * parts - dim)] for r in rows.orderBy(*order).limit(entries).collect()]
    books: Books = [[v[p * width : (p + 1) * width] for v in filled] for p in range(parts)]
    many = len(filled)
    ids, labels = df.schema[key].dataType, df.schema[label].dataType
    out_schema = f"key {ids.simpleString()}, label {labels.simpleString()}, codes binary, error long"
    if not many:
        empty = spark.createDataFrame([], f"{out_schema}, label_error long")
        return empty.select(F.col("key").alias(key), F.col("label").alias(label), "codes", "error", "label_error"), books
    columns = {"keys_of": ArrayType(ids), "labels_of": ArrayType(labels)}
    packed = {"kind": pa.string(), "x": pa.binary(), "codes": pa.binary(), "sizes": pa.binary(), "keys": pa.binary(), "rows": pa.binary()}
    arrow = [(n, to_arrow_type(t)) for n, t in columns.items()] + list(packed.items()) + [("moved", pa.list_(pa.decimal128(38, 0)))]
    schema = ", ".join([*(f"{n} {t.simpleString()}" for n, t in columns.items()), *(f"{n} {'string' if n == 'kind' else 'binary'}" for n in packed), "moved array<decimal(38,0)>"])

    def row_of(of: Block, keys_of: list, labels_of: list) -> pa.RecordBatch:
        values = {"keys_of": keys_of, "labels_of": labels_of, **_pack(of), "moved": [Decimal(int(x)) for x in of.moved.ravel()]}
        return pa.RecordBatch.from_arrays([pa.array([values[n]], t) for n, t in arrow], schema=pa.schema(arrow))

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(table: pa.Table) -> pa.RecordBatch:
            x = np.zeros((table.num_rows, parts * width), np.int64)
            x[:, :dim] = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            return row_of(Block.first(x.reshape(-1, parts, width), books), table["key"].to_pylist(), table["label"].to_pylist())

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block:
                table = pa.Table.from_batches(held)
                yield made(table.slice(0, block))
                held = table.slice(block).to_batches()
        if any(b.num_rows for b in held):
            yield made(pa.Table.from_batches(held))

    def next_round(books: Books, drift: list[list[float]]):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    of = _unpack(row, parts, many)
                    of.again(books, drift)
                    yield row_of(of, row["keys_of"], row["labels_of"])

        return run

    def last(books: Books, drift: list[list[float]]):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    of = _unpack(row, parts, many)
                    of.again(books, drift)
                    values = [row["keys_of"], row["labels_of"], [c.tobytes() for c in of.codes], of.errors(books)]
                    kinds = [to_arrow_type(ids), to_arrow_type(labels), pa.binary(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["key", "label", "codes", "error"])

        return run

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a task's blocks have moved, added up."""
        found: np.ndarray = np.zeros(parts * many * (width + 1), object)
        for batch in batches:
            for moved in batch.column(0):
                found = found + np.array([int(x) for x in moved.as_py()], object)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([Decimal(found[i]) for i in at], pa.decimal128(38, 0))], names=["at", "n"])

    sums = [0] * (parts * many * (width + 1))
    drift = [[0.0] * many for _ in range(parts)]
    state = rows.mapInArrow(first, schema)
    for at in range(rounds):
        state = stash(state)
        for r in state.select("moved").mapInArrow(total, "at int, n decimal(38,0)").groupBy("at").agg(F.sum("n").alias("n")).collect():  # a number for each component of an entry
            sums[r["at"]] += int(r["n"])
        of = np.array(sums, object).reshape(parts, many, width + 1)
        new = [[[int(s) // int(e[-1]) for s in e[:-1]] if e[-1] else old for e, old in zip(p, book, strict=True)] for p, book in zip(of, books, strict=True)]
        drift, books = _moves(books, new, drift), new
        if at < rounds - 1:
            state = state.mapInArrow(next_round(books, drift), schema)
    out = stash((state if rounds else stash(state)).mapInArrow(last(books, drift), out_schema))
    of_label = out.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    side = small_side(of_label.withColumnRenamed("label", "_label"), BROADCAST_LABELS)
    joined = out.join(side, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(F.col("key").alias(key), F.col("label").alias(label), "codes", "error", "label_error"), books
