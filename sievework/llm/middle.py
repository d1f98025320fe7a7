"""Fill-in-the-middle: texts cut at two places and put in the order prefix, suffix, middle, or suffix first.

Where a text is cut is counted in units (code points, words or lines). A byte automaton (automata.py) counts them and finds
marks that would confuse the output. Texts of up to CHUNK bytes are summed up and searched where they lie, many at once.
Longer ones are cut into chunks that any task may take: each chunk gives its map of states with counts, the maps of a text
are composed to the state and count at which every chunk is entered, and only the chunks that hold a cut are searched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, small_side
from .automata import Automaton, Grouped, Sums, Tree, compile_automaton, prefixes
from .blocks import bound_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Of a hundred texts, those that stay plain; of a hundred others, those whose suffix comes first.
PLAIN, SPM = 10, 20
#: Bytes of a text that one task works on at once.
CHUNK = 1 << 16
#: Bytes of texts that one tree is built over.
_TREE = 1 << 18
#: Texts beyond CHUNK up to which their cuts are broadcast.
BROADCAST_CUTS = 1_000_000

_CUTS = "n long, marked boolean, a long, b long"


def _data(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and the ends of its values; nulls are empty."""
    column = column.fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def _groups(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of _TREE bytes, or of one text."""
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + _TREE, "right")))
        yield at, to
        at = to


def _trees(grouped: Grouped, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, Tree]]:
    """Ranges of rows with their lengths in bytes and their tree."""
    data, ends = _data(column)
    for a, b in _groups(ends):
        before = int(ends[a - 1]) if a else 0
        own = ends[a:b] - before
        yield a, b, np.diff(own, prepend=0), Tree(grouped, data[before : int(ends[b - 1])], own)


def _wanted(n: np.ndarray, h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """[which, text]: units before the first and before the second cut."""
    return np.sort(np.stack([h % (n + 1), g % (n + 1)]), axis=0)


def cuts(text: Column, first: Column, second: Column, of: Automaton) -> Column:
    """n (units), marked, and the bytes before the two cuts; first and second are drawn numbers, of which the remainders by n + 1 count."""
    grouped = Grouped(of)

    def work(texts: pa.Array, h: pa.Array, g: pa.Array) -> pa.Array:
        hs, gs = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in (h, g))
        out = np.zeros((4, len(texts)), np.int64)
        for a, b, lengths, tree in _trees(grouped, texts):
            n, marked = (x[:, 0].astype(np.int64) for x in (tree.roots.unit, tree.roots.mark))
            out[0, a:b], out[1, a:b] = n, marked
            for row, want in zip((2, 3), _wanted(n, hs[a:b], gs[a:b]), strict=True):
                inside = np.flatnonzero(want < n)
                out[row, a:b] = lengths
                out[row, a + inside] = tree.find(inside, np.zeros(len(inside), np.int64), want[inside])
        return pa.StructArray.from_arrays([pa.array(out[0]), pa.array(out[1] > 0), pa.array(out[2]), pa.array(out[3])], names=["n", "marked", "a", "b"])

    return F.arrow_udf(work, _CUTS)(text.cast("binary"), first, second)


def _chunks(long: DataFrame, chunk: int) -> DataFrame:
    """own (the text's digest), h, g, at, data: the chunks of texts, dealt out to all tasks."""
    size = F.octet_length("text")
    at = F.explode(F.sequence(F.lit(0), F.ceil(size / chunk).cast("int") - 1)).alias("at")
    rows = long.select("own", "h", "g", F.col("text").cast("binary").alias("text"), at)
    return rows.select("own", "h", "g", "at", F.substring("text", F.col("at") * chunk + 1, F.lit(chunk)).alias("data"))


def long_cuts(long: DataFrame, of: Automaton, chunk: int = CHUNK) -> DataFrame:
    """own, h, g, cut (as of cuts()) for texts cut into chunks; long: own, h, g, text."""
    grouped, states = Grouped(of), of.states

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, lengths, tree in _trees(grouped, batch.column("data")):
                roots, rows = tree.roots, batch.slice(a, b - a)
                packed = [[x.tobytes() for x in np.ascontiguousarray(y, np.int64)] for y in (roots.step, roots.unit, roots.mark)]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("own", "h", "g", "at")), pa.array(lengths), *map(pa.array, packed)], names=["own", "h", "g", "at", "bytes", "step", "unit", "mark"])

    def enter(table: pa.Table) -> pa.Table:
        """For each cut of a text: the chunk that holds it (null at the end of the text), the state it is entered in, and units to go."""
        table = table.sort_by("at").group_by(["own", "h", "g", "at"], use_threads=False).aggregate([(c, "first") for c in ("bytes", "step", "unit", "mark")]).sort_by("at")
        arrays = [np.frombuffer(b"".join(table[f"{c}_first"].to_pylist()), np.int64).reshape(-1, states) for c in ("step", "unit", "mark")]
        upto = prefixes(Sums(*arrays))
        after = upto.unit[:, 0]
        n = int(after[-1])
        h, g = (np.array(table[c].to_pylist()[:1], np.int64) for c in ("h", "g"))
        want = _wanted(np.array([n]), h, g)[:, 0]
        held = np.searchsorted(after, want, "right")
        inside = held < len(after)
        before = [int(after[k - 1]) if k else 0 for k in held.tolist()]
        state = [int(upto.step[k - 1, 0]) if k else 0 for k in held.tolist()]
        same = {c: [table[c][0].as_py()] * 2 for c in ("own", "h", "g")}
        return pa.table(
            {**same, "which": pa.array([0, 1], pa.int32()), "n": [n] * 2, "marked": [bool(upto.mark[-1, 0])] * 2, "bytes": [int(np.sum(table["bytes_first"].to_numpy()))] * 2,
             "at": pa.array([int(k) if i else None for k, i in zip(held, inside, strict=True)], pa.int32()), "state": state, "togo": [int(w) - b for w, b in zip(want, before, strict=True)]}
        )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, tree in _trees(grouped, batch.column("data")):
                rows = batch.slice(a, b - a)
                state, togo = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("state", "togo"))
                found = tree.find(np.arange(b - a), state, togo) + rows.column("at").to_numpy(zero_copy_only=False).astype(np.int64) * chunk
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("own", "h", "g", "which")), pa.array(found)], names=["own", "h", "g", "which", "place"])

    key = "own string, h long, g long"
    parts = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _chunks(long, chunk).repartition(parts, "own", "at")
    mapped = dealt.mapInArrow(sums, f"{key}, at int, bytes long, step binary, unit binary, mark binary")
    entered = small_side(mapped.groupBy("own", "h", "g").applyInArrow(enter, f"{key}, which int, n long, marked boolean, bytes long, at int, state long, togo long"), 2 * BROADCAST_CUTS)
    held = _chunks(long, chunk).join(entered.where(F.col("at").isNotNull()), ["own", "h", "g", "at"]).select("own", "h", "g", "which", "at", "state", "togo", "data")
    places = held.mapInArrow(search, f"{key}, which int, place long").distinct()
    ended = entered.where(F.col("at").isNull()).select("own", "h", "g", "which", F.col("bytes").alias("place"))
    at = lambda k: F.max(F.when(F.col("which") == k, F.col("place")))
    both = places.unionByName(ended).groupBy("own", "h", "g").agg(at(0).alias("a"), at(1).alias("b"))
    out = entered.where(F.col("which") == 0).select("own", "h", "g", "n", "marked").join(both, ["own", "h", "g"])
    return out.select("own", "h", "g", F.struct("n", "marked", "a", "b").alias("cut"))


def draws(key: Column, seed: str = "1:") -> list[Column]:
    """Four numbers from the seed and the key: the first 8-digit groups of the hex sha256."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", plain: int = PLAIN, spm: int = SPM, chunk: int = CHUNK) -> DataFrame:
    """key, n (units), form (plain, psm, spm), prefix, middle, suffix (null if plain), output.

    The cuts come from four numbers drawn from the key, so equal rows fare alike wherever they lie. Plain are empty texts,
    those that contain a mark, and `plain` of a hundred others; of a hundred of the rest `spm` start with their suffix.
    Null texts are empty, null keys draw from the seed alone; repeated rows stay; an empty table gives no rows; other
    columns of the table are left out. A text is one row, so it must fit in a task, but no array of its length is built.
    """
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    of = compile_automaton(unit, MARKS)
    h = draws(F.col(key))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), h[0].alias("h"), h[1].alias("g"), h[2].alias("as_is"), h[3].alias("order"))
    short, long = rows.where(F.octet_length("text") <= chunk), rows.where(F.octet_length("text") > chunk).withColumn("own", F.sha2("text", 256))
    known = small_side(long_cuts(long.select("own", "h", "g", "text"), of, chunk), BROADCAST_CUTS)
    cut = short.withColumn("cut", cuts(F.col("text"), F.col("h"), F.col("g"), of)).unionByName(long.join(known, ["own", "h", "g"]).drop("own"))
    form = F.when((F.col("text") == "") | F.col("cut.marked") | (F.col("as_is") % 100 >= 100 - plain), "plain").when(F.col("order") % 100 < spm, "spm").otherwise("psm")
    data = F.col("text").cast("binary")
    part = lambda a, b: F.when(F.col("form") != "plain", F.substring(data, a + 1, b - a).cast("string"))
    a, b = F.col("cut.a").cast("int"), F.col("cut.b").cast("int")
    parts = cut.withColumn("form", form).select(
        F.col("key").alias(key), F.col("cut.n").alias("n"), "form", "text", part(F.lit(0), a).alias("prefix"), part(a, b).alias("middle"), part(b, F.octet_length("text")).alias("suffix")
    )
    put = lambda *xs: F.concat(*(x if isinstance(x, Column) else F.lit(x) for x in xs))
    p, m, s = (F.col(x) for x in ("prefix", "middle", "suffix"))
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", put(PREFIX, p, SUFFIX, s, MIDDLE, m)).otherwise(put(SUFFIX, s, PREFIX, p, MIDDLE, m))
    return parts.select(key, "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text from its output: what stands between the marks, which no part contains, in its first order."""

    def after(x: Column, mark: str) -> Column:
        return F.substring(x, F.locate(mark, x) + len(mark), F.length(x))

    def until(x: Column, mark: str) -> Column:
        return F.substring_index(x, mark, 1)

    psm = F.concat(until(after(output, PREFIX), SUFFIX), after(output, MIDDLE), until(after(output, SUFFIX), MIDDLE))
    spm = F.concat(until(after(output, PREFIX), MIDDLE), after(output, MIDDLE), until(after(output, SUFFIX), PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
