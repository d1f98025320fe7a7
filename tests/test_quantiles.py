import random

import numpy as np

from sievework.operators import features


def test_quantiles_as_numpy_finds_them(spark):
    pick = random.Random(1)
    groups = {
        "plain": [pick.gauss(0, 1) for _ in range(500)],
        "ties": [float(pick.randrange(3)) for _ in range(400)],
        "one": [4.5],
        "wide": [pick.choice([-1, 1]) * 10.0 ** pick.randrange(-9, 9) for _ in range(300)],
        "near": [1 + k * 2.0**-52 for k in range(60)],
        None: [2.0, 1.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("plain", None), ("plain", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    shares = [0.0, 0.03, 0.5, 0.97, 1.0]
    got = {r["_g"]: r["q"] for r in features.exact_quantiles(df, "g", "v", shares).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        ordered, places = sorted(vs), [(len(vs) - 1) * s for s in shares]
        for q, p in zip(got[g], places, strict=True):
            low, high = ordered[int(np.floor(p))], ordered[int(np.ceil(p))]
            assert low <= q <= high or abs(q - low) <= 1e-9 * abs(low)
        if g != "wide":
            assert np.allclose(got[g], np.quantile(vs, shares), rtol=1e-12, atol=1e-15)


def test_rescaled_rows_keep_their_columns(spark):
    df = spark.createDataFrame([("a", float(i), "x") for i in range(101)] + [(None, 1.0, "y"), ("b", None, "z")], "g string, v double, q string")
    out = features.clip_rescale(df, "g", "v", 0.1, 0.9)
    assert out.columns == ["g", "v", "q", "scaled"]
    got = {r.v: r.scaled for r in out.where("g = 'a'").collect()}
    assert got[0.0] == got[10.0] == 0 and got[90.0] == got[100.0] == 1 and abs(got[50.0] - 0.5) < 1e-12


def test_codes_of_values(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), ("c", 5)], "x string, _value int").drop("_value")
    for most in (0, 100):
        assert sorted(((r.x, r.code) for r in features.dictionary_codes(df, "x", most).collect()), key=repr) == sorted([("b", 1), ("a", 0), (None, None), ("b", 1), ("c", 2)], key=repr)
    assert features.dictionary_codes(df.where("false"), "x").collect() == []
