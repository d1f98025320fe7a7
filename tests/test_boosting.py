import math
import random

import numpy as np
from pyspark.sql import functions as F

from sievework.operators import boosting


def plain(rows, features, tags, folds, rounds, depth, bins):
    """(key, tag) -> score, one tree and one node at a time."""
    cuts = []
    for f in features:
        values = sorted(r[f] for r in rows if r[f] is not None and not math.isnan(r[f]))
        last = {}
        for i, v in enumerate(values):
            upto = max(j for j, w in enumerate(values) if w == v)
            last[(upto * (bins - 1)) // len(values)] = v
        cuts.append(sorted(last.values()))
    place = lambda v, c: 0 if v is None or math.isnan(v) else min(1 + sum(x < v for x in c), bins)
    b = [[place(r[f], c) for f, c in zip(features, cuts, strict=True)] for r in rows]
    out = {}
    for k in range(folds):
        for t in tags:
            margin = [0.0] * len(rows)
            mine = [i for i, r in enumerate(rows) if r["fold"] != k and r[t] is not None]
            for _ in range(rounds):
                g, h = boosting.gradients(np.array([rows[i][t] if rows[i][t] is not None else -1 for i in range(len(rows))]), np.array(margin))
                g, h = g.tolist(), h.tolist()

                def grown(members, everyone, level):
                    total = sum(g[i] for i in members) / boosting.UNIT, sum(h[i] for i in members) / boosting.UNIT
                    if level == depth:
                        for i in everyone:
                            margin[i] += -boosting.RATE * total[0] / (total[1] + boosting.SMOOTH)
                        return
                    best = (1e-9, None)
                    for f in range(len(features)):
                        for cut in range(bins + 1):
                            left = [i for i in members if b[i][f] <= cut]
                            lg, lh = sum(g[i] for i in left) / boosting.UNIT, sum(h[i] for i in left) / boosting.UNIT
                            if lh > 0 and total[1] - lh > 0:
                                s = lambda x, y: x * x / (y + boosting.SMOOTH)
                                gain = s(lg, lh) + s(total[0] - lg, total[1] - lh) - s(*total)
                                if gain > best[0] + (1e-12 if best[1] else 0):
                                    best = (gain, (f, cut))
                    right = (lambda i: best[1] is not None and b[i][best[1][0]] > best[1][1])
                    for side in (False, True):
                        grown([i for i in members if right(i) == side], [i for i in everyone if right(i) == side], level + 1)

                grown(mine, list(range(len(rows))), 0)
            out |= {(r["id"], t): 1 / (1 + math.exp(-m)) for r, m in zip(rows, margin, strict=True) if r["fold"] == k and r[t] is not None}
    return out


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else None


def given(n=150):
    pick = random.Random(3)
    rows = []
    for i in range(n):
        x, y = pick.gauss(0, 1), float(pick.randrange(6))
        rows.append({"id": i, "fold": i % 3, "x": pick.choice([x, x, x, None]), "y": float("nan") if i % 17 == 0 else y, "a": int(x + y / 3 > 1), "b": pick.choice([None, int(y > 2)]), "c": None})
    return rows


def test_scores_as_by_one_tree_at_a_time_on_any_partitioning(spark):
    rows = given()
    how = dict(folds=3, rounds=3, depth=2, bins=6)
    expected = plain(rows, ["x", "y"], ["a", "b"], **how)
    for parts in (1, 5):
        df = spark.createDataFrame([(r["id"], r["fold"], r["x"], r["y"], r["a"], r["b"], r["c"]) for r in rows], "id long, fold int, x double, y double, a int, b int, c int").repartition(parts)
        got = boosting.cross_scores(df, "id", ["x", "y"], ["a", "b", "c"], F.col("fold"), **how).collect()
        assert {(r.id, r.tag) for r in got} == expected.keys()
        assert all(abs(r.score - expected[r.id, r.tag]) < 1e-9 for r in got)
    measured = {r.tag: r for r in boosting.rank_measure(spark.createDataFrame(got), ["tag"], "score", "label").collect()}
    for tag in "ab":
        assert abs(measured[tag].auc - auc([(r.score, r.label) for r in got if r.tag == tag])) < 1e-12 and measured[tag].auc > 0.8


def test_the_measure_without_both_labels_and_without_rows(spark):
    df = spark.createDataFrame([("p", 0.5, 1), ("p", 0.7, 1), ("q", 0.5, 0), ("q", 0.5, 1), (None, 0.1, 0), (None, 0.2, 1)], "g string, s double, y int")
    assert {r.g: r.auc for r in boosting.rank_measure(df, ["g"], "s", "y").collect()} == {"p": None, "q": 0.5, None: 1.0}
    assert boosting.rank_measure(df.where("false"), ["g"], "s", "y").collect() == []
    empty = spark.createDataFrame([], "id long, x double, a int")
    assert boosting.cross_scores(empty, "id", ["x"], ["a"], F.lit(0), folds=2, rounds=1, depth=1).collect() == []
