import random
import re

from sievework.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items):
    out = []
    for d, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for i, it in items:
            iw = WORD.findall(lower(it))
            n = min(13, len(iw))
            grams = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(str(i))
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def data():
    rng = random.Random(1)
    vocabulary = ["a", "b", "É", "é", "ab", "c3", "Kelvin", "kelvin", "straße", "x"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, make(rng.choice([1, 3, 7, 12, 13, 14, 40]))) for i in range(12)] + [(50, None), (51, ""), (52, "..."), (3, make(20)), (53, "A " * 30), (54, "a " * 13)]
    docs = [(i, make(rng.choice([0, 5, 60]))) for i in range(30)]
    for i in range(30, 80):
        item = rng.choice(items)[1] or ""
        words = item.split()
        cut = words[rng.randrange(len(words) + 1) :] if rng.random() < 0.5 else words
        docs.append((i, make(rng.choice([0, 9, 300])) + ", " + "-".join(w.upper() if w.isascii() else w for w in cut) + "! " + make(7)))
    return docs + [(90, None), (91, ""), (92, "a " * 3000), docs[40], (None, docs[41][1]), (45, "another text")], items


def got(out):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in out.collect()), key=repr)


def test_like_brute_force(spark):
    docs, items = data()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("x", "x").selectExpr("doc_id", "text", "'e' AS items", "1 AS n_words")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert got(decontamination.contamination(d, b)) == want
    assert got(decontamination.contamination(d, b, broadcast_rows=0)) == want
    assert got(decontamination.contamination(d, b, broadcast_docs=0)) == want
    kept = decontamination.clean(d, b)
    assert kept.columns == d.columns and kept.count() == sum(not w[-1] for w in want)
    long_items = [(i, t) for i, t in items if len(WORD.findall(lower(t))) >= 13]
    assert got(decontamination.contamination(d, spark.createDataFrame(long_items, "item_id long, text string"))) == brute(docs, long_items)


def test_empty_tables(spark):
    docs, items = data()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(decontamination.contamination(d.limit(0), b)) == []
    assert got(decontamination.contamination(d, b.limit(0))) == brute(docs, [])
