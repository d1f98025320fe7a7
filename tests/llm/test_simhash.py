import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from sievework.llm import simhash
from sievework.llm.pigeonhole import divide


def fingerprint(text):
    words = [w for w in _split(_lower(text or ""))]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def _split(t):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", t)


def brute(rows):
    fp = [(r.doc_id, fingerprint(r.text)) for r in rows]
    top = list(range(len(fp)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(fp)):
        for j in range(i):
            if bin(fp[i][1] ^ fp[j][1]).count("1") <= 4:
                top[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(fp):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, f, least.get(root(i))) for i, (d, f) in enumerate(fp)), key=repr)


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["É", "naïve", "X"]
    out = [Row(doc_id=i, text=" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 40, 400])))) for i in range(120)]
    for i in range(120, 260):  # chains of near copies
        base = out[i - rng.choice([120, 1, 2])].text.split()
        base[rng.randrange(len(base))] = rng.choice(words)
        out.append(Row(doc_id=i, text=" ".join(base)))
    return out + [Row(doc_id=300, text=None), Row(doc_id=301, text=""), Row(doc_id=302, text=" \n\t "), Row(doc_id=None, text=out[0].text), out[5], Row(doc_id=303, text="word " * 20000)]


def got(df, **more):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component) for r in simhash.group(df, **more).collect()), key=repr)


def test_like_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(df) == want
    assert got(df, bucket=3) == want  # every bucket cut into blocks
    assert len({c for _, _, c in want}) < len(want) - 50


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e", "x", 2), (2, "a b c d e", "y", 3)], "doc_id long, text string, fp string, component int")
    assert [r.doc_id for r in simhash.keep_one(df).collect()] == [1]
    assert simhash.keep_one(df).columns == df.columns
    assert simhash.group(df.limit(0)).collect() == []


def test_every_near_pair_shares_a_bucket(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(50)]
    near = [b ^ sum(1 << x for x in rng.sample(range(64), 4)) for b in base]
    for n in (100, 10**6, 10**9):
        groups = divide(np.full((64, 64), n / 4) + np.eye(64) * n / 4, n, 4)
        assert sum(g.near + 1 for g in groups) == 5
        for a, b in zip(base, near, strict=True):
            assert any(bin((a ^ b) & sum(1 << x for x in g.bits)).count("1") <= g.near for g in groups)


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (_split(_lower(t or "")) for t in (a, b)))
    return len(x & y) / len(x | y) if x | y else 1.0


def fingerprint5(text):
    words = _split(_lower(text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 5]).encode(), 42) for i in range(max(1, len(words) - 4))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def kept_by_brute_force(rows, distance=simhash.COPY_DISTANCE, least=simhash.COPY_SIMILARITY):
    """Which (doc_id, text) stay: one of each group of equal fingerprints, or near ones with similar texts."""
    fp = [fingerprint5(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if fp[i] == fp[j] or (bin(fp[i] ^ fp[j]).count("1") <= distance and jaccard(rows[i][1], rows[j][1]) >= least):
                top[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i])
    return groups


def test_one_row_of_each_group_stays(spark):
    a, b = " ".join(f"a{i}" for i in range(90)), " ".join(f"b{i}" for i in range(90))
    near = a.replace("a7 ", "edit ")
    def ask(rows):
        df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
        return sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=repr)

    assert ask([(1, a), (5, a), (5, b)]) == [(1, a), (5, b)]
    assert ask([(1, a), (1, a), (2, a), (None, near)]) == [(1, a)]
    assert ask([(None, a), (None, a), (3, None), (4, "")]) == sorted([(None, a), (3, None)], key=repr)


def test_near_copies_like_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([2, 30, 150, 240])))) for i in range(40)]
    for i in range(40, 160):
        base = rows[rng.randrange(len(rows))][1].split()
        for _ in range(rng.choice([0, 1, 2, 4])):
            base[rng.randrange(len(base))] = f"w{rng.randrange(5000)}"
        rows.append((i, " ".join(base)))
    groups = kept_by_brute_force(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for bucket in (simhash.BUCKET, 7):
        assert sorted(r.doc_id for r in simhash.keep_one(df, bucket=bucket).collect()) == sorted(min(d for d, _ in g) for g in groups.values())
    # Of the documents that similarity alone would drop nearly all go.
    gone = lambda groups: {d for g in groups.values() for d, _ in g} - {min(d for d, _ in g) for g in groups.values()}
    exact = gone(kept_by_brute_force(rows, 64))
    assert gone(groups) <= exact and len(gone(groups)) >= 0.9 * len(exact)


def test_sketches():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    assert simhash.resemblance(simhash.sketch(x[:200]), simhash.sketch(x[20:200])) == 0.9
    assert abs(simhash.resemblance(simhash.sketch(x), simhash.sketch(x[:4000])) - 0.8) < 0.08
    assert simhash.resemblance(b"", b"") == 1 and simhash.resemblance(b"", simhash.sketch(x)) == 0


def test_dense_buckets_keep_groups_together(spark):
    """A group of thousands around one text, in one bucket or cut into blocks, is one group."""
    rng = random.Random(9)
    base = rng.getrandbits(64)
    words = sorted({base} | {base ^ sum(1 << x for x in rng.sample(range(64), 2)) for _ in range(1500)})
    fps = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in words], "fp long")
    own = fps.withColumn("sketch", F.lit(b""))
    for every in (False, True):
        found = simhash.links(fps, 4, 500, every)
        found = (simhash._similar(found, own, 4, 0.8) if every else found).collect()
        top = {}

        def root(x):
            while top.get(x, x) != x:
                x = top[x]
            return x

        for r in found:
            top[root(r.a)] = root(r.b)
        assert len({root(r.fp) for r in fps.collect()}) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_buckets_lose_no_near_copy(spark, seed):
    """Edits of one text, all in a few bits of each other, not all of them similar: what stays is what all pairs say, at any size of blocks."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.choice([2, 5, 8, 12])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    expected = sorted(min(d for d, _ in g) for g in kept_by_brute_force(rows).values())
    assert 1 < len(expected) < 390
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for bucket in (4_096, 100):
        assert sorted(r.doc_id for r in simhash.keep_one(df, bucket=bucket).collect()) == expected


def test_verified_forests_join_what_all_links_join():
    rng = random.Random(6)
    for full in (False, True):
        base = [rng.getrandbits(64) for _ in range(400 if full else 120)]
        own = [np.array(sorted(set(rng.sample(base, int(len(base) * rng.uniform(0.8, 1))))), np.uint64) for _ in range(60)] + [np.zeros(0, np.uint64)] * 2
        words = np.array([rng.getrandbits(12) for _ in own], np.uint64)
        sketches = [simhash.sketch(x) for x in own]

        def parts(pairs):
            top = list(range(len(own)))
            for a, b in pairs:
                old, new = top[a], top[b]
                top = [new if t == old else t for t in top]
            return {frozenset(i for i, t in enumerate(top) if t == x) for x in top}

        every = [(a, b) for a in range(len(own)) for b in range(a) if bin(int(words[a]) ^ int(words[b])).count("1") <= 6 and simhash.resemblance(sketches[a], sketches[b]) >= 0.8]
        tree = simhash.verified_forest(words, sketches, 6, 0.8)
        assert set(tree) <= set(every) | {(b, a) for a, b in every} and parts(tree) == parts(every)
