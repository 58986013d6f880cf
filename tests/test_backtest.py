from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.operators import backtest as bt
from loadcast.operators import forecast as fc


def test_folds_equal_fits_on_their_own_rows(spark, gappy):
    g = gappy.withColumn("load_mw_clean_lag_24", F.lit(1.0)).cache()
    cuts = bt.cutoffs(g, 3, 5)
    newest = g.agg(F.max("timestamp_utc")).first()[0]
    assert cuts == [newest - dt.timedelta(days=d) for d in (15, 10, 5)]
    s = bt.with_segment(g, cuts)
    seasonal = {(r["country"], r["timestamp_utc"]): r["prediction"] for r in bt.seasonal_folds(s, cuts).collect()}
    first = g.agg(F.min("timestamp_utc")).first()[0]
    span = (cuts[0] - first).total_seconds() / 3600
    rows, names = fc.seasonal_design(s, F.lit(first).cast("timestamp_ntz"), F.lit(span))
    pdf = rows.toPandas()
    n = 0
    for zone, own in pdf.groupby("country"):
        for f in (1, 2, 3):
            train, test = own[own.seg < f], own[own.seg == f]
            x, y = train[names].to_numpy(float), train["load_mw_clean"].to_numpy(float)
            a = x.T @ x
            w = np.linalg.solve(a + 1e-3 * max(np.trace(a) / len(names), 1) * np.eye(len(names)), x.T @ y)
            want = test[names].to_numpy(float) @ w
            got = [seasonal[zone, t.to_pydatetime()] for t in test["timestamp_utc"]]
            assert got == pytest.approx(want.tolist(), rel=1e-6)
            n += len(test)
    assert n == len(seasonal)
    seq = bt.sequence_folds(s, cuts, length=6, bucket_steps=48).toPandas()
    base = s.filter("seg = 0").agg(F.avg("load_mw_clean"), F.stddev_samp("load_mw_clean")).first()
    zs = s.orderBy("country", "timestamp_utc").toPandas()
    windows = []
    for zone, own in zs.groupby("country"):
        v = ((own["load_mw_clean"] - base[0]) / base[1]).to_numpy()
        x = np.lib.stride_tricks.sliding_window_view(v, 6)[:-1]
        windows += [(zone, t, k, xi, yi) for t, k, xi, yi in zip(own["timestamp_utc"][6:], own["seg"][6:], x, v[6:], strict=True)]
    got = {(r.country, r.timestamp_utc): r.prediction for r in seq.itertuples()}
    for f in (1, 2, 3):
        x, y = (np.array([w[i] for w in windows if w[2] < f]) for i in (3, 4))
        d = np.column_stack((np.ones(len(x)), x))
        w = np.linalg.solve(d.T @ d + 1e-3 * len(d) * np.diag([0.0] + [1.0] * 6), d.T @ y)
        for zone, t, k, xi, _ in windows:
            if k == f:
                assert got[zone, t] == pytest.approx((w[0] + xi @ w[1:]) * base[1] + base[0], rel=1e-6)


def test_four_models_a_fold(spark, gappy):
    g = gappy.withColumn("load_mw_clean_lag_24", F.col("load_mw_clean") + 5.0).cache()
    got = bt.rolling_origin(g, 3, 5, length=6).groupBy("fold", "model").agg(F.count("prediction").alias("n"), F.avg(F.abs(F.col("y") - F.col("prediction"))).alias("e")).collect()
    assert len(got) == 12 and all(r["n"] > 0 for r in got)
    assert all(abs(r["e"] - 5) < 1e-9 for r in got if r["model"] == "seasonal_naive")
