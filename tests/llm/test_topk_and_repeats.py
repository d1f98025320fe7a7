import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import pivots, recompression


def brute_topk(rows):
    own = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or math.isnan(x) or math.isinf(x) for x in v):
            continue
        w = [math.floor(256 * np.float64(np.float32(x))) for x in v]
        own[i] = min(own[i], w) if i in own else w
    out = []
    for q, a in own.items():
        if q % 50 == 0:
            best = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in own.items() if c != q and len(b) == len(a)))[:5]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


def test_topk_like_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(i, rows[50][1]) for i in range(500, 540)]  # ties
    rows += [(600, None), (650, []), (601, [1.0, None] * 4), (602, [float("nan")] * 8), (603, [float("inf")] * 8), (None, rows[0][1]), (50, rows[51][1]), (51, rows[51][1]), (700, [1.0, 2.0]), (701, [3.0, 4.0]), (750, [0.0] * 8)]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "vec_id long, embedding array<float>, rank int, score int")
    want = brute_topk(rows)
    for more in ({}, {"query_block": 3, "candidate_block": 37}):
        assert sorted(tuple(r) for r in pivots.top_k(df, **more).collect()) == want
    assert pivots.top_k(df.limit(0)).collect() == []
    huge = [(0, [3e8, 1.0]), (1, [3e5, -7.0]), (2, [3e5, 9.0])]
    got = pivots.top_k(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, int(256 * 3e8) * int(256 * 3e5) + 256 * 256 * 9), (1, int(256 * 3e8) * int(256 * 3e5) - 256 * 256 * 7)]


def evaluated_share(c, queries, k=5):
    """Share of products evaluated, with the results held against all products."""
    pivots = pivots_of(c)
    ids, far = np.arange(len(c)), pivots.distances(c.astype(float))
    q = c[:queries]
    floor = pivots_module.floors(q, ids[:queries], c[:2000], ids[:2000], k)
    who, what, score, evaluated = pivots_module.search(pivots, q, ids[:queries], far[:queries], floor, c, ids, far, k)
    for i in range(queries):
        full = sorted((-int(s), j) for j, s in enumerate(c @ q[i]) if j != i)[:k]
        assert [(-s, j) for w, j, s in zip(who, what, score, strict=True) if w == i] == full
    return evaluated / (queries * len(c))


pivots_module = pivots


def pivots_of(c):
    return pivots.choose_pivots(c[:2000].astype(float))


def test_bounds_leave_candidates_out():
    rng = np.random.default_rng(4)
    plane = np.floor(rng.normal(size=(2000, 2)) * 256).astype(np.int64)
    assert evaluated_share(plane, 20) < 0.2
    sphere = rng.normal(size=(4000, 64))
    sphere = np.floor(256 * sphere / np.linalg.norm(sphere, axis=1)[:, None]).astype(np.int64)
    assert evaluated_share(sphere, 40) < 0.2  # nothing but the dimension to go by
    low = np.floor(rng.normal(size=(4000, 8)) @ rng.normal(size=(8, 64)) * 50 + rng.normal(size=(4000, 64))).astype(np.int64)
    assert evaluated_share(low, 40) < 0.1 and len(pivots_of(low).vectors) <= 16


def test_bounds_hold():
    """The bound is at least the inner product, and as tight as that of any single pivot."""
    rng = np.random.default_rng(6)
    c = np.floor(rng.normal(size=(300, 16)) * 256)
    for many in (1, 5, 16):
        p = pivots.Pivots(c, many)
        far, norms = p.distances(c), (c * c).sum(axis=1)
        above = pivots.bounds(p.places(far, norms), p.places(far, norms))
        single = (norms[:, None] + norms - np.abs(far[:, None, :] - far[None, :, :]).max(axis=2) ** 2) / 2
        assert (above >= c @ c.T - 0.5).all() and (above <= single + 0.5).all()  # of a million or so


def brute_repeats(docs, window):
    first, every = {}, []
    for d, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        every.append((d, w))
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if d is not None:
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in every:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["é", "x y", "A", "a"]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [make(n) for n in (49, 50, 51, 70, 200)]
    docs = [(i, make(rng.choice([0, 10, 49, 50, 51, 300]))) for i in range(60)]
    for i in range(60, 200):
        parts = [make(rng.choice([0, 3, 60]))]
        for _ in range(rng.choice([1, 2])):
            passage = list(rng.choice(shared)) if rng.random() < 0.6 else list(docs[rng.randrange(len(docs))][1])
            if passage and rng.random() < 0.4:
                passage[rng.randrange(len(passage))] = "edit"
            parts += [passage, make(rng.choice([0, 5]))]
        docs.append((i, [w for p in parts for w in p]))
    docs += [(300, ["run"] * 500), (301, ["run"] * 60), (302, ["run"] * 50 + ["end"]), (303, ["ab", "cd"] * 200), (304, ["cd", "ab"] * 30), (305, [])]
    docs = [(i, rng.choice([" ", "\n", "  \t"]).join(w)) for i, w in docs]
    return docs + [(306, None), docs[70], (None, docs[71][1]), (71, docs[71][1] + " more words"), (-5, docs[80][1])]


def got(out):
    return sorted((tuple(r) for r in out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()), key=repr)


def test_repeats_like_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n int, name string")
    want = brute_repeats(docs, 50)
    assert sum(w[2] for w in want) > 3000
    assert got(recompression.remove(df)) == want
    assert got(recompression.remove(df, broadcast_rows=-1)) == want
    assert got(recompression.remove(df, window=30)) == brute_repeats(docs, 30)
    assert got(recompression.remove(df.limit(0))) == []


def test_a_block_twice_in_a_later_document(spark):
    """A document that owns contexts holds them at several places; all windows of an earlier one go at each of them."""
    rng = random.Random(11)
    make = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    docs = []
    for k in range(12):
        p, x, y = make(rng.choice([50, 60, 75, 200])), make(rng.choice([1, 10, 60])), make(rng.choice([1, 10, 60]))
        block = [*x, *p, *y]
        docs += [(10 * k, p), (10 * k + 1, [*block, *make(k % 3), *block]), (10 * k + 2, [*block, *block, *block])]
        docs.append((10 * k + 3, [*p, *p]))
    docs += [(200, ["run"] * 60), (201, [*(["run"] * 300), "end", *(["run"] * 300)])]
    docs = [(i, " ".join(w)) for i, w in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for window in (50, 30):
        assert got(recompression.remove(df, window=window)) == brute_repeats(docs, window)
    assert got(recompression.remove(df, broadcast_rows=-1)) == brute_repeats(docs, 50)


def test_proper_symbols_agree():
    """In two equal windows the proper symbols are the same, whatever surrounds them; so is the one that is chosen."""
    rng = np.random.default_rng(5)
    for alphabet in (1, 2, 5, 1000):
        pool = rng.integers(0, 1 << 62, alphabet).astype(np.uint64)
        passage = pool[rng.integers(0, alphabet, 50)]
        seen, chosen = [], []
        for _ in range(6):
            left, right = (pool[rng.integers(0, alphabet, rng.integers(0, 40))] for _ in range(2))
            text, a = np.concatenate([left, passage, right]), len(left)
            parse = recompression.Parse(text, np.array([len(text)]), 50)
            for number in range(5):
                born = parse.round(number)
                inside = (born.lo >= a) & (born.hi <= a + 50)
                seen.append({(number, int(s) - a, int(n)) for s, n in zip(born.start[inside], born.names[inside], strict=True)})
                parse.know(born, recompression.Filter(3, np.full(1, 255, np.uint8)))
            at, name, level = parse.chosen()
            w = int(np.flatnonzero(at == a)[0])
            chosen.append((int(name[w]), int(level[w])))
        assert all(seen[k] == seen[k % 5] for k in range(len(seen))) and all(c == chosen[0] for c in chosen)
        assert alphabet < 1000 or (seen[0] and chosen[0][1] > 1)


def test_rows_of_one_id_are_apart(spark):
    """A row whose words stand nowhere else stays whole though its doc_id is that of a row with repeats; ids may be texts."""
    a, b = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    docs = [(1, a), (5, a), (5, b), (5, b)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_repeats(docs, 50)
    assert [(r[0], r[2]) for r in want].count((5, 0)) == 2 and got(recompression.remove(df)) == want
    texts = df.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert sorted(r[2] for r in got(recompression.remove(texts))) == [0, 0, 0, 80]


def test_a_round_that_clashes_is_named_anew(spark, monkeypatch):
    born = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (3, 3, 1), (3, 3, 2), (4, 4, 1)], "name long, made_of long, doc_id long")
    monkeypatch.setattr(recompression, "_births", lambda rows, rounds, seed, window: born if seed == 0 else born.where("name > 1"))
    done, many = recompression._named(born, [], 50)
    assert done.seed == 1 and many == 1
    assert done.shared.has(np.array([3], np.uint64)).all()
    names = np.random.default_rng(1).integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2)
    held = recompression._filter(spark.createDataFrame([(int(x),) for x in names[:1000].view(np.int64)], "name long"), 1000)
    assert held.has(names[:1000]).all() and held.has(names[1000:]).mean() < 0.1
