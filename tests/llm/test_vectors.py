import math

import numpy as np
import pytest

from sievework.llm import vectors
from sievework.llm.covertree import CoverTree, Joined, Side


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def brute(rows, least):
    """(vec_id, n_links, component, kept) of each row."""
    able = [lab is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, lab, v in rows]
    n, near = len(rows), {i: set() for i in range(len(rows))}
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if able[i] and able[j] and a[1] == b[1] and len(a[2]) == len(b[2]):
                if sum(x * y for x, y in zip(a[2], b[2], strict=True)) >= least * math.sqrt(sum(x * x for x in a[2]) * sum(y * y for y in b[2])):
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least_id = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least_id, rows[i][0] == least_id))
    return sorted(out, key=repr)


def given(seed, spread, n=130, dim=6):
    pick = np.random.default_rng(seed)
    centres = unit(pick.normal(size=(4, dim)))
    x = np.concatenate([centres[pick.integers(0, 4, n)] + pick.normal(size=(n, dim)) * spread, pick.normal(size=(n // 2, dim))])
    rows = [(int(i), int(pick.integers(0, 2)), [float(np.float32(a)) for a in v]) for i, v in zip(pick.permutation(len(x)), x, strict=True)]
    odd = [(900, None, rows[0][2]), (901, 1, None), (902, 1, [0.0] * dim), (903, 0, [float("nan")] * dim), (904, 0, [None] * dim), (905, 1, []), (906, 0, [1e-200] * dim), (907, 0, [3e200] * dim), (908, 0, [1.0, 2.0])]
    rows = [r for r in rows if r[0] != 12] + odd
    return rows + rows[:3] * 2 + [(None, rows[5][1], rows[5][2]), (None, None, None), (5000, rows[7][1], rows[7][2])]


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, path string, rows int").repartition(3)
    return sorted(((r.vec_id, r.n_links, r.component, r.kept) for r in vectors.near_duplicates(df, **how).collect()), key=repr)


@pytest.mark.parametrize(("spread", "least", "block"), [(0.05, 0.98, 4096), (0.05, 0.98, 9), (0.01, 0.98, 7), (0.3, 0.6, 16)])
def test_links_and_components_as_by_all_pairs(spark, spread, least, block):
    rows = [r for r in given(int(spread * 100), spread) if r[0] not in (906, 907)]
    assert run(spark, rows, least=least, block=block) == brute(rows, least)


def test_equal_vectors_vectors_of_any_size_and_none(spark):
    same = [(i, 1, [0.25, 0.5]) for i in range(60)] + [(100 + i, 1, [0.25 * 2.0**i, 0.5 * 2.0**i]) for i in range(5)] + [(7, 1, [0.25, 0.5]), (200, 2, [0.25, 0.5])]
    got = run(spark, same, block=8)
    assert got == brute(same, 0.98) and sum(k for _, _, _, k in got) == 2
    assert run(spark, [(1, 0, [1e-200, 0.0]), (2, 0, [3e200, 0.0]), (3, 0, [0.0, 1e-300])]) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert run(spark, []) == []
    assert run(spark, [(3, None, [1.0]), (None, 1, None)]) == [(3, 0, 3, True), (None, 0, None, True)]


@pytest.mark.parametrize("spread", [0.002, 0.02, 0.05])
def test_two_trees_find_every_pair_and_measure_few(spread):
    pick = np.random.default_rng(4)
    centres = unit(pick.normal(size=(12, 24)))
    x, y = (unit(centres[pick.integers(0, 12, n)] + pick.normal(size=(n, 24)) * spread) for n in (900, 500))
    sides = []
    for points in (x, y):
        tree = CoverTree.over(points)
        weights = pick.integers(1, 4, len(points))
        for start, end, radius, first, many in tree.nodes.tolist():
            own = points[tree.order[int(start) : int(end)]]
            assert np.sqrt(np.maximum(2 - 2 * own @ own[0], 0)).max() <= radius + 1e-7
            assert not many or tree.nodes[int(first)][0] == start
        sides.append(Side(points[tree.order], weights, tree.nodes))
    a, b = sides
    near = a.points @ b.points.T >= 0.98
    both = Joined(a, b, 0.98)
    assert (both.links == np.concatenate([near @ b.weights, near.T @ a.weights])).all()
    own = a.points @ a.points.T >= 0.98
    np.fill_diagonal(own, False)
    alone = Joined(a, None, 0.98)
    assert (alone.links == own @ a.weights).all()
    if spread < 0.01:
        assert both.measured < 0.1 * near.size and alone.measured < 0.1 * own.size
    for i, j in zip(*np.nonzero(own), strict=True):
        assert alone.label[i] == alone.label[j]
