from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from loadcast.operators import attribution as at
from loadcast.operators import forecast as fc


def expected(tree, x, known, k=0):
    """Value of a node when only ``known`` features count (training shares else)."""
    if tree["left"][k] < 0:
        return tree["value"][k]
    lo, hi = tree["left"][k], tree["right"][k]
    if tree["feature"][k] in known:
        return expected(tree, x, known, lo if x[tree["feature"][k]] <= tree["threshold"][k] else hi)
    return sum(tree["count"][c] / tree["count"][k] * expected(tree, x, known, c) for c in (lo, hi))


def shapley(trees, weights, x):
    m = len(x)
    value = {s: sum(w * expected(t, x, s) for t, w in zip(trees, weights, strict=True)) for r in range(m + 1) for s in itertools.combinations(range(m), r)}
    out = np.zeros(m)
    for s, v in value.items():
        for i in set(range(m)).difference(s):
            share = math.factorial(len(s)) * math.factorial(m - len(s) - 1) / math.factorial(m)
            out[i] += share * (value[tuple(sorted((*s, i)))] - v)
    return out, value[()]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(5)
    rows = [(i, rng.random(), float(rng.randrange(4)), rng.gauss(0, 1), rng.random()) for i in range(400)]
    df = spark.createDataFrame([(*r, 3 * r[1] + r[2] * r[3] + (r[4] > 0.5)) for r in rows], "i long, a double, b double, c double, d double, y double")
    model = fc.fit_gbt(df, label="y", features=["a", "b", "c", "d"], max_iter=6, max_depth=5, min_instances=2)
    return df, model


def test_tree_attribution_matches_the_definition(spark, fitted):
    df, model = fitted
    names = ["a", "b", "c", "d"]
    rows = df.limit(25).union(spark.createDataFrame([(-1, None, 1.0, 1.0, 1.0, 0.0), (-2, 9.0, -9.0, 0.0, 0.5, 0.0)], df.schema))
    phi, baseline = at.tree_attribution(model.stages[-1], rows, names, ["i"])
    got = {}
    for r in phi.collect():
        got.setdefault(r["i"], {})[r["feature"]] = r["phi"]
    trees, weights = at.tree_tables(model.stages[-1])
    predicted = {r["i"]: r["prediction"] for r in fc.predict(model, rows).collect()}
    assert -1 not in got and len(got) == 26
    for r in rows.filter("i <> -1").collect():
        want, base = shapley(trees, weights, [r[n] for n in names])
        assert baseline == pytest.approx(base)
        assert [got[r["i"]][n] for n in names] == pytest.approx(want.tolist(), abs=1e-9)
        assert sum(got[r["i"]].values()) + baseline == pytest.approx(predicted[r["i"]])


def test_linear_attribution_adds_up(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 1.0)], "i long, a double, b double")
    got = {(r["i"], r["feature"]): r["phi"] for r in at.linear_attribution(df, {"a": 2.0, "b": -1.0}, {"a": 1.5, "b": 1.0}, ["i"]).collect()}
    assert got == {(1, "a"): 1.0, (1, "b"): -2.0, (2, "a"): None, (2, "b"): 0.0}


def test_sequence_model_is_the_ridge_of_its_windows(spark, synthetic):
    fitted = fc.fit_sequence(synthetic, length=12, bucket_steps=48)
    y = np.array([r[0] for r in synthetic.orderBy("timestamp_utc").select("load_mw_clean").collect()])
    z = (y - y.mean()) / y.std(ddof=1)
    x = np.lib.stride_tricks.sliding_window_view(z, 12)[:-1]
    t, n = z[12:], len(z) - 12
    cut = math.floor(0.9 * n)
    errors = {}
    for p in fc.PENALTIES:
        for rows, keep in ((slice(0, cut), True), (slice(0, n), False)):
            d = np.column_stack((np.ones(len(t[rows])), x[rows]))
            w = np.linalg.lstsq(d.T @ d + p * len(d) * np.diag([0.0] + [1.0] * 12), d.T @ t[rows], rcond=None)[0]
            if keep:
                errors[p] = math.sqrt(np.mean((np.column_stack((np.ones(n - cut), x[cut:])) @ w - t[cut:]) ** 2))
            elif p == fitted["penalty"]:
                assert [fitted["intercept"], *fitted["coef"]] == pytest.approx(w.tolist(), abs=1e-6)
    assert dict(fitted["path"]) == pytest.approx(errors, rel=1e-6)
    assert errors[fitted["penalty"]] == pytest.approx(min(errors.values()), rel=1e-9) and (fitted["n_train"], fitted["n_validation"]) == (cut, n - cut)
