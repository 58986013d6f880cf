from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from loadcast.operators import drift as dr
from loadcast.sources import testdata as td


def _brute_ks(a, b):
    a, b = np.sort(a), np.sort(b)
    v = np.concatenate([a, b])
    fa = np.searchsorted(a, v, side="right") / len(a)
    fb = np.searchsorted(b, v, side="right") / len(b)
    return float(np.max(np.abs(fa - fb)))


def test_ks_statistic_matches_brute_force(spark):
    ev = td.table(spark, SF01, "events").withColumnRenamed("ts", "timestamp_utc")
    lab = dr.label_windows(ev, ref_days=20, cur_days=7)
    got = dr.ks_per_feature(lab, ["value"], values_per_range=50).first()
    pdf = lab.filter(F.col("drift_window").isNotNull()).select("drift_window", "value").toPandas()
    ref = pdf[pdf.drift_window == "reference"].value.to_numpy()
    cur = pdf[pdf.drift_window == "current"].value.to_numpy()
    assert got["n_ref"] == len(ref) and got["n_cur"] == len(cur)
    assert abs(got["ks_stat"] - _brute_ks(ref, cur)) < 1e-12


def test_identical_windows_no_drift(spark):
    rows = [("reference", float(i % 50)) for i in range(500)] + [("current", float(i % 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "drift_window string, x double")
    per = dr.ks_per_feature(df, ["x"])
    r = per.first()
    assert r["ks_stat"] == 0 and r["p_value"] == 1.0 and not r["drifted"]
    assert dr.drift_share(per).first()["drift_share"] == 0


def test_shifted_mean_drifts(spark):
    rows = [("reference", float(i % 97)) for i in range(500)] + [("current", float(i % 97) + 40) for i in range(500)]
    df = spark.createDataFrame(rows, "drift_window string, x double")
    r = dr.ks_per_feature(df, ["x"]).first()
    assert r["drifted"] and r["p_value"] < 1e-6


def test_pvalue_against_series(spark):
    """Both series branches agree with the textbook Kolmogorov series."""
    from loadcast.functions.stats import ks_pvalue

    def q(lam):
        return float(2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 200)))

    for d, n, m in [(0.05, 1000, 800), (0.1, 300, 300), (0.2, 120, 150)]:
        got = spark.range(1).select(ks_pvalue(F.lit(d), F.lit(float(n)), F.lit(float(m)))).first()[0]
        ne = n * m / (n + m)
        lam = (np.sqrt(ne) + 0.12 + 0.11 / np.sqrt(ne)) * d
        assert abs(got - min(1.0, max(0.0, q(lam)))) < 1e-9


def test_insufficient_rows(spark):
    rows = [("2024-01-01 00:00:00", 1.0)] * 10
    df = spark.createDataFrame(rows, "timestamp_utc string, x double").withColumn(
        "timestamp_utc", F.col("timestamp_utc").cast("timestamp_ntz"))
    lab = dr.label_windows(df, 20, 7)
    rep = dr.drift_report(lab, ["x"]).first()
    assert rep["status"] == "insufficient" and rep["drift_share"] == 0.0 and rep["drift_detected"] is False


def _counted(x):
    v, c = np.unique(x, return_counts=True)
    return dict(zip(v.tolist(), (c / len(x)).tolist(), strict=True))


def test_distances_match_brute_force(spark):
    rng = np.random.default_rng(3)
    ref = {"x": np.round(rng.normal(0, 3, 900), 1), "k": rng.integers(0, 4, 900).astype(float), "c": np.full(900, 2.0)}
    cur = {"x": np.round(rng.normal(1, 2, 400), 1), "k": rng.integers(1, 5, 400).astype(float), "c": np.full(400, 2.0)}
    rows = [("reference", *map(float, r)) for r in zip(*ref.values(), strict=True)] + [("current", *map(float, r)) for r in zip(*cur.values(), strict=True)]
    df = spark.createDataFrame(rows + [("current", None, float("nan"), None)], "drift_window string, x double, k double, c double")
    for per_range in (100_000, 7):  # ranges of a few values: gaps and counts cross their borders
        got = {r["feature"]: r for r in dr.drift_scores(df, ["x", "k", "c"], per_range).collect()}
        for f in ref:
            v = np.unique(np.concatenate((ref[f], cur[f])))
            fa = np.searchsorted(np.sort(ref[f]), v, side="right") / 900
            fb = np.searchsorted(np.sort(cur[f]), v, side="right") / 400
            area = float((np.abs(fa - fb)[:-1] * np.diff(v)).sum()) / max(ref[f].std(), 0.001)
            p, q = _counted(ref[f]), _counted(cur[f])
            js = sum(a * np.log(2 * a / (a + b)) / 2 for a, b in [(p.get(k, 0), q.get(k, 0)) for k in v] + [(q.get(k, 0), p.get(k, 0)) for k in v] if a > 0)
            assert (got[f]["n_ref"], got[f]["n_cur"], got[f]["n_values"]) == (900, 400, len(v))
            assert abs(got[f]["ks_stat"] - np.abs(fa - fb).max()) < 1e-12
            assert abs(got[f]["wasserstein"] - area) < 1e-9 and abs(got[f]["jensenshannon"] - np.sqrt(max(0.0, js))) < 1e-7
    picked = {r["feature"]: (r["method"], r["drifted"]) for r in dr.drift_per_feature(df, ["x", "k", "c"], many_rows=1000).collect()}
    assert picked == {"x": ("ks", True), "k": ("jensenshannon", True), "c": ("jensenshannon", False)}
    assert {r["method"] for r in dr.drift_per_feature(df, ["x"], many_rows=500).collect()} == {"wasserstein"}


def test_one_window_alone_has_no_scores(spark):
    df = spark.createDataFrame([("reference", float(i)) for i in range(20)], "drift_window string, x double")
    r = dr.drift_scores(df, ["x"]).first()
    assert r["n_cur"] == 0 and r["ks_stat"] is None and r["wasserstein"] is None and r["jensenshannon"] is None
    assert dr.drift_scores(df.limit(0), ["x"]).collect() == []
