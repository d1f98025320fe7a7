import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import codes

SCHEMA = "vec_id long, label int, embedding array<double>, error string, codes int"


def brute(rows, parts, entries, rounds, scale=256):
    """(vec_id, label, codes, error, label_error) of each kept row, and the codebooks, by plain Python integers."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    width = -(-len(kept[0][2]) // parts)
    kept = [(i, lab, v + [0] * (width * parts - len(v))) for i, lab, v in kept]
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, _, v in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [(nearest(cut(v)[p], book), cut(v)[p]) for _, _, v in kept]
            groups = [[x for e, x in own if e == at] for at in range(len(book))]
            books[p] = [[sum(c) // len(g) for c in zip(*g, strict=True)] if g else old for g, old in zip(groups, book, strict=True)]
    out = []
    for i, lab, v in kept:
        code = [nearest(x, book) for x, book in zip(cut(v), books, strict=True)]
        out.append((i, lab, bytes(code), sum(far(x, b[e]) for x, b, e in zip(cut(v), books, code, strict=True))))
    labels = {lab: sum(r[3] for r in out if r[1] == lab) for _, lab, _ in kept}
    return sorted([(*r, labels[r[1]]) for r in out], key=repr), books


def given(dim, n, seed, spread=0.01):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 0.3) for _ in range(dim)] for _ in range(9)]
    rows = [(i, pick.choice([None, 0, 1, 2]), [x + pick.gauss(0, spread) for x in pick.choice(centres)]) for i in range(n)]
    rows += [(n, 1, None), (n + 1, 1, [float("nan")] * dim), (n + 2, 1, [None] + [0.1] * (dim - 1)), (n + 3, 2, [float("inf")] * dim), (n + 4, 1, []), (n + 5, 1, [0.5] * (dim + 1))]
    return rows + rows[3:8] + [(None, 0, [0.2] * dim), (5, 2, [-0.3] * dim), (None, None, [0.0] * dim)]


def run(spark, rows, partitions=3, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(partitions)
    out, books = codes.quantise(df, **how)
    return sorted(((r.vec_id, r.label, bytes(r.codes), r.error, r.label_error) for r in out.collect()), key=repr), books


@pytest.mark.parametrize(("dim", "parts", "entries", "rounds"), [(8, 4, 8, 2), (10, 4, 5, 3), (6, 2, 64, 1), (4, 4, 3, 0)])
def test_codes_books_and_errors_as_by_plain_integers(spark, dim, parts, entries, rounds):
    rows = given(dim, 150, dim)
    for partitions, block in ((1, 8192), (3, 16)):
        got, books = run(spark, rows, partitions, parts=parts, entries=entries, rounds=rounds, block=block)
        assert (got, books) == brute(rows, parts, entries, rounds)


def test_large_components_stay_exact(spark):
    pick = random.Random(1)
    rows = [(i, i % 3, [float(pick.randrange(-(1 << 20), 1 << 20)) for _ in range(4)]) for i in range(60)]
    got, books = run(spark, rows, parts=2, entries=7)
    assert (got, books) == brute(rows, 2, 7, 2)


def test_fewer_rows_than_entries_ties_and_no_rows(spark):
    rows = [(4, None, [0.1, 0.2]), (2, None, [0.1, 0.2]), (3, 1, [0.1, 0.2])]
    got, books = run(spark, rows, parts=2, entries=64)
    assert (got, books) == brute(rows, 2, 64, 2) and all(r[2] == b"\0\0" for r in got)
    assert run(spark, [(1, 1, None)]) == ([], [[] for _ in range(16)])
    assert run(spark, []) == ([], [[] for _ in range(16)])


def test_only_what_the_drift_has_reached_is_compared_again():
    pick = np.random.default_rng(2)
    centres = pick.integers(-500, 500, (8, 3, 4))
    x = centres[pick.integers(0, 8, 900)] + pick.integers(-3, 4, (900, 3, 4))
    books = [[c[p].tolist() for c in centres + 1] for p in range(3)]
    block = codes.Block.first(x, books)
    moved = [[[a + 1 for a in e] for e in book] for book in books]
    block.again(moved, codes._moves(books, moved, [[0.0] * 8] * 3))
    assert block.compared < 0.2 * x.shape[0] * 3
    for p in range(3):
        far = ((x[:, p, None] - np.array(moved[p])[None]) ** 2).sum(axis=2)
        assert (far.argmin(axis=1) == block.codes[:, p]).all()
    assert sum(len(h) for heaps in block.heaps for h in heaps) == x.shape[0] * 3


def test_columns_of_the_same_names_are_left_out(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25], 3, "a")], "id long, v array<double>, group int, key string")
    out, _ = codes.quantise(df, "id", "v", "group", parts=2)
    assert out.columns == ["id", "group", "codes", "error", "label_error"] and out.where(F.col("error") == 0).count() == 1
