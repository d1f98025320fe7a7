"""Benchmark decontamination by winnowing.

A benchmark item's windows are 13 consecutive words (an item of fewer words is one window). Of the k-word hashes in a
window the least is kept, the leftmost if several are least. Equal windows keep the same hash at the same place, so
every document window that equals an item's window shares a fingerprint with it: joining the fingerprints of both
sides misses none. Each shared fingerprint is then extended word by word to both sides, which also undoes hash
collisions; where at least a whole window agrees, its words are hit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, fits, small_side
from .natives import let, lower_ascii

WINDOW, GRAM = 13, 5
#: Benchmark fingerprints up to which they are broadcast (none has more than 21 words); beyond, the join shuffles.
BROADCAST_ROWS = 100_000
#: Documents, and fingerprints in them, up to which those found are broadcast to pick out texts; beyond, texts are shuffled.
BROADCAST_DOCS, BROADCAST_PAIRS = 100_000, 200_000
#: Contaminated documents up to which their keys are broadcast to leave them out; beyond, texts are shuffled.
BROADCAST_IDS = 1_000_000
#: A fingerprint is 33 bits of hash above 31 bits of position, so that the least hash is also the leftmost.
_PLACE = 31
#: A mark that no k-gram has; it brings each document's number of words along.
_SENTINEL = -1
# All of ASCII but letters and digits, one by one: Java tests such a class with a table.
_BREAK = "[" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


def words(text: Column) -> Column:
    """In the case in which they stand; what counts is their form under lower_ascii()."""
    return F.coalesce(F.array_remove(F.split(text, _BREAK), ""), F.array().cast("array<string>"))


def word_hashes(w: Column | str) -> Column:
    """Hashes that are equal for words that are equal but for A-Z; lower() does more than that, which verification undoes."""
    return F.transform(w, lambda x: F.xxhash64(F.lower(x)))


def _fingerprints(hashes: Column, /, *, window: int) -> Column:
    """The winnowed fingerprints of all windows of so many words: hash << 31 | place of the k-gram, distinct."""
    gram = min(GRAM, window)
    width = window - gram + 1  # k-grams in a window

    def packed(h: Column, hs: Column, i: Column) -> Column:
        grams = F.xxhash64(F.lit(window), h, *(F.get(hs, i + k) for k in range(1, gram)))
        return grams.bitwiseAND(F.lit(-1 << _PLACE)).bitwiseOR(i.cast("long"))

    def least(values: Column, *steps: int) -> Column:
        return let(values, lambda v: F.transform(v, lambda x, i: F.least(x, *(F.get(v, i + k) for k in steps))))

    grams = let(hashes, lambda hs: F.transform(hs, lambda h, i: packed(h, hs, i)))
    out = F.slice(grams, 1, F.greatest(F.size(hashes) - gram + 1, F.lit(0)))
    have = 1
    while have * 3 <= width:
        out, have = least(out, have, 2 * have), have * 3
    if have * 2 < width:
        out = least(out, have, width - have)
    elif have < width:
        out = least(out, width - have)
    return F.array_distinct(F.slice(out, 1, F.greatest(F.size(hashes) - window + 1, F.lit(0))))


def _of(window: int) -> Callable[[Column], Column]:
    return lambda h: _fingerprints(h, window=window)


def _hash_of(mark: Column) -> Column:
    return F.shiftright(mark, _PLACE)


def _place_of(mark: Column) -> Column:
    return mark.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int")


def benchmark_fingerprints(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """hash, window (words in a window), gram, context (words around the k-gram, joined by spaces), at (its place in them), items (ids).

    Items that share a fingerprint and the words around it share a row. Null ids and texts without words give none.
    """
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("window", F.least(F.size("w"), F.lit(window)))
    hashes = word_hashes("w")
    marks = F.coalesce(*(F.when(F.col("window") == n, let(hashes, _of(n))) for n in range(window, 0, -1)))
    gram = F.least(F.col("window"), F.lit(GRAM))
    start = F.greatest(F.col("q") - F.col("window") + F.col("gram"), F.lit(0))
    return (
        items.select("item", "w", "window", gram.alias("gram"), F.explode(marks).alias("m"))
        .select("item", "w", "window", "gram", _hash_of(F.col("m")).alias("hash"), _place_of(F.col("m")).alias("q"))
        .select("item", "window", "gram", "hash", lower_ascii(F.array_join(F.slice("w", start + 1, F.col("q") - start + F.col("window")), " ")).alias("context"), (F.col("q") - start).alias("at"))
        .groupBy("hash", "window", "gram", "context", "at")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _extend(w: Column, pair: Column) -> Column:
    """start and stop of the longest agreement around a fingerprint, in document words."""
    p, at = pair["p"], pair["at"]
    same = F.transform(F.split(pair["context"], " "), lambda x, j: x.eqNullSafe(lower_ascii(F.get(w, p - at + j))))

    def ends(eq: Column) -> Column:
        before = F.array_position(F.reverse(F.slice(eq, 1, at)), F.lit(False)).cast("int")
        after = F.array_position(F.slice(eq, at + 1, F.size(eq)), F.lit(False)).cast("int")
        start = F.when(before == 0, F.lit(0)).otherwise(at - before + 1)
        stop = F.when(after == 0, F.size(eq)).otherwise(at + after - 1)
        whole = (stop - start >= pair["window"]) & (stop >= at + pair["gram"])
        return F.struct((p - at + start).alias("start"), F.when(whole, p - at + stop).alias("stop"), pair["items"].alias("items"))

    return let(same, ends)


def _candidates(docs: DataFrame, marks: DataFrame, broadcast_rows: int) -> DataFrame:
    """doc_id, text_hash, n_words, n_rows (equal rows), pairs (fingerprints found in the document) of each document."""
    lengths = marks.groupBy("window").count().collect()  # one row for each length of window, 13 at most
    lengths, many = sorted(r["window"] for r in lengths), sum(r["count"] for r in lengths)
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    every = let(word_hashes("w"), lambda h: F.concat(F.array(F.lit(_SENTINEL).cast("long")), *(_fingerprints(h, window=n) for n in lengths)))
    marked = source.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), every.alias("m"))
    exploded = marked.select("doc_id", "text_hash", "n_words", F.explode("m").alias("m")).select("doc_id", "text_hash", "n_words", "m", _hash_of(F.col("m")).alias("hash"), _place_of(F.col("m")).alias("p"))
    pair = F.struct("p", "window", "gram", "context", "at", "items")
    if many <= broadcast_rows and fits(marks, broadcast_rows):
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in marks.schema if f.name != "hash"]
        sentinel = marks.sparkSession.range(1).select(F.lit(_SENTINEL).cast("long").alias("hash"), *nothing)
        found = exploded.join(F.broadcast(marks.unionByName(sentinel)), "hash").where((F.col("m") == _SENTINEL) | F.col("window").isNotNull())
    else:
        real = exploded.where(F.col("m") != _SENTINEL).join(marks, "hash")
        counted = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words(F.col("text"))).cast("long").alias("n_words"), F.lit(_SENTINEL).cast("long").alias("m"))
        found = real.drop("hash").unionByName(counted, allowMissingColumns=True)
    return found.groupBy("doc_id", "text_hash").agg(F.max("n_words").alias("n_words"), F.count_if(F.col("m") == _SENTINEL).alias("n_rows"), F.collect_set(F.when(F.col("window").isNotNull(), pair)).alias("pairs"))


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS, broadcast_docs: int = BROADCAST_DOCS) -> DataFrame:
    """doc_id, text_hash, n_words, n_rows, n_hit, items for each different document."""
    ensure_checkpoint_dir(docs.sparkSession)
    found = _candidates(docs, benchmark_fingerprints(benchmark, window).checkpoint(), broadcast_rows).checkpoint()
    some = found.where(F.size("pairs") > 0)
    sizes = some.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("pairs")), F.lit(0)).alias("pairs")).first()
    pairs = some.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "pairs")
    small = sizes["docs"] <= broadcast_docs and sizes["pairs"] <= BROADCAST_PAIRS and fits(pairs, broadcast_docs)
    pairs = F.broadcast(pairs) if small else pairs
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    texts = texts.join(pairs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    # The words are bound by let(): a column of a lower projection would be merged into the lambda and split anew for each word.
    spans = let(words(F.col("text")), lambda w: F.filter(F.transform("pairs", lambda pair: _extend(w, pair)), lambda s: s["stop"].isNotNull()))
    spans = texts.select("doc_id", "text_hash", spans.alias("spans"))
    result = spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), _covered(F.col("spans")).alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("spans.items"))).alias("items")).dropDuplicates(["_id", "_hash"])
    out = found.drop("pairs").join(result, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return out.select("doc_id", "text_hash", "n_words", "n_rows", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _covered(spans: Column) -> Column:
    """Words in the union of spans."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, x: Column) -> Column:
        fresh = F.greatest(x["stop"] - F.greatest(x["start"], acc["at"]), F.lit(0)).cast("long")
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), (acc["n"] + fresh).alias("n"))

    places = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    return F.aggregate(F.array_sort(places), start, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **limits: int) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as strings, sorted), contaminated for each row of docs.

    Null and empty texts have no words and aren't contaminated. Repeated rows each give a row; rows that share a doc_id
    but not a text are judged apart; the doc_id may be null. An empty benchmark hits nothing.
    """
    out = judged(docs, benchmark, window, **limits)
    out = out.select("doc_id", "n_words", "n_hit", "items", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")).alias("row")).drop("row")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **limits: int) -> DataFrame:
    """The rows of docs that aren't contaminated, with all their columns."""
    out = judged(docs, benchmark, window, **limits).where((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    bad = small_side(out.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), BROADCAST_IDS)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"]), "left_anti")
