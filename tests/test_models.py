from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from loadcast.operators import anomaly as an
from loadcast.operators import evaluate as ev
from loadcast.operators import forecast as fc
from loadcast.schemas import ANOMALY_FEATURES


def _split(gold, days):
    g = ev.time_split(gold, days).withColumn("y", F.col("load_mw_clean"))
    return g.filter("split = 'train'"), g.filter("split = 'test'")


def test_time_split_no_overlap(synthetic_gold):
    train, test = _split(synthetic_gold, 3)
    assert train.count() > 0 and test.count() > 0
    assert train.agg(F.max("timestamp_utc")).first()[0] < test.agg(F.min("timestamp_utc")).first()[0]


def test_metrics_zero_on_perfect_prediction(synthetic_gold):
    m = ev.forecast_metrics(synthetic_gold.withColumn("y", F.col("load_mw_clean"))
                            .withColumn("prediction", F.col("load_mw_clean"))).first()
    assert m["mape"] == 0 and m["rmse"] == 0 and m["mae"] == 0


def test_gbt_smoke_and_quality(synthetic_gold):
    """Predictions for every test row, not all zero, beat the mean, MAPE < 0.25."""
    train, test = _split(synthetic_gold, 2)
    model = fc.fit_gbt(train, max_iter=30, max_depth=4, step_size=0.1, min_instances=5)
    pred = fc.predict(model, test)
    assert pred.count() == test.count()
    assert pred.filter(F.col("prediction") != 0).count() > 0
    gbt = ev.forecast_metrics(pred).first()["mape"]
    base = ev.forecast_metrics(ev.mean_baseline(train, test)).first()["mape"]
    assert gbt < base and gbt < 0.25


def test_seasonal_model_beats_mean(synthetic):
    # the full 14 days: training covers a weekend, so the weekly terms are identified
    train, test = _split(synthetic, 2)
    coefs, st = fc.fit_seasonal(train, changepoints=2, yearly=0)
    m = ev.forecast_metrics(fc.predict_seasonal(test, coefs, st)).first()["mape"]
    base = ev.forecast_metrics(ev.mean_baseline(train, test)).first()["mape"]
    assert m < base and m < 0.25


def test_sequence_model_finite_after_window(spark, synthetic):
    from loadcast.operators.features import build_gold
    g = build_gold(synthetic, bucket_steps=None, drop=False)
    g = ev.time_split(g, 2).withColumn("y", F.col("load_mw_clean"))
    fitted = fc.fit_sequence(g.filter("split = 'train'"), length=6, bucket_steps=None)
    pred = fc.predict_sequence(fitted, g).orderBy("timestamp_utc").select("prediction").collect()
    vals = [r[0] for r in pred]
    assert all(v is None for v in vals[:6])
    assert all(v is not None and math.isfinite(v) for v in vals[6:])


def test_isolation_forest_share_and_spike(spark, synthetic_gold):
    # a planted anomaly: every load-derived feature of one row is far out
    at = F.col("timestamp_utc") == F.lit("2023-05-15 12:00:00").cast("timestamp_ntz")
    spiked = synthetic_gold.withColumns({c: F.when(at, F.lit(90000.0)).otherwise(F.col(c)) for c in
                                         ["load_mw_clean", "load_mw_clean_lag_24", "load_mw_clean_lag_168",
                                          "load_mw_clean_roll_mean_24", "load_mw_clean_roll_std_24"]})
    scored, nodes, *_ = an.train_anomaly(spiked, n_trees=50, contamination=0.05, sample_size=128)
    share = scored.agg(F.avg("is_anomaly")).first()[0]
    assert 0 < share < 0.2
    top = scored.orderBy("anomaly_score").first()
    assert str(top["timestamp_utc"]) == "2023-05-15 12:00:00"
    assert nodes.select("tree_id").distinct().count() == 50
    assert nodes.agg(F.max("size")).first()[0] <= 128


def test_scores_do_not_depend_on_batch(spark, synthetic_gold):
    """Imputation uses training means, so a row scores the same alone or in a batch."""
    scored, nodes, means, _ = an.train_anomaly(synthetic_gold, n_trees=20, sample_size=64)
    offset = F.lit(0.0)
    one = synthetic_gold.limit(1)
    a = an.detect(one, nodes, offset, ANOMALY_FEATURES, means).select("raw_score").first()[0]
    whole = an.detect(synthetic_gold, nodes, offset, ANOMALY_FEATURES, means)
    key = one.select("timestamp_utc").first()[0]
    b = whole.filter(F.col("timestamp_utc") == F.lit(key)).select("raw_score").first()[0]
    assert abs(a - b) < 1e-12


def test_champion_tie_goes_to_first_declared(spark):
    m = spark.createDataFrame([("b", 0.1), ("a", 0.1), ("c", 0.2)], "model string, mape double")
    assert ev.champion_pick(m, ["a", "b", "c"]).first()["model"] == "a"
    assert ev.champion_pick(m, ["b", "a", "c"]).first()["model"] == "b"


def test_rows_with_a_missing_feature_stay_without_a_prediction(synthetic_gold):
    train, test = _split(synthetic_gold, 2)
    model = fc.fit_gbt(train, max_iter=3, max_depth=3, min_instances=5)
    feature = model.stages[0].getInputCols()[-1]
    holes = test.withColumn(feature, F.when(F.hour("timestamp_utc") != 5, F.col(feature)))
    n = test.filter(F.hour("timestamp_utc") == 5).count()
    pred = fc.predict(model, holes)
    assert n > 0 and pred.count() == test.count()
    assert pred.filter("prediction is null").count() == n == pred.filter("prediction is null and hour(timestamp_utc) = 5").count()
    whole = fc.predict(model, test).select("timestamp_utc", "prediction").exceptAll(pred.select("timestamp_utc", "prediction"))
    assert whole.count() == n


def test_every_family_is_stored_resolved_and_refuses_a_wrong_signature(spark, synthetic, tmp_path):
    import datetime as dt

    import pytest
    from loadcast.operators import anomaly as an
    from loadcast.operators import ledger as lg
    from loadcast.operators import models
    from loadcast.operators.features import build_gold
    from loadcast.operators.training import CANDIDATES, ledger_records, train_forecasters
    gold = build_gold(synthetic, zone_map={"ES": "ES"}, bucket_steps=None, drop=False).cache()
    metrics, runs = train_forecasters(gold, 2, {"max_iter": 3, "max_depth": 3}, seq_len=24, save_dir=f"{tmp_path}/models")
    nodes, means = an.fit_forest(gold, n_trees=20, sample_size=64), an.impute_means(gold, an.ANOMALY_FEATURES)
    offset = an.fit_offset(an.score_samples(gold.na.drop(subset=an.ANOMALY_FEATURES), nodes, sample_size=64), 0.05)
    signature = models.save_model(spark, "isolation_forest", (nodes, offset, means, 64), f"{tmp_path}/forest", gold)
    records = ledger_records(metrics, runs) + [{"family": "isolation_forest", "alias": "anomaly", "model_path": f"{tmp_path}/forest", "signature": signature}]
    ledger = f"{tmp_path}/ledger"
    lg.append_ledger(lg.ledger_rows(spark, records), ledger)
    assert {r["family"] for r in records} == {*CANDIDATES, "isolation_forest"} and all(r["signature"] for r in records)
    champion = next(r for r in records if r["alias"] == "champion")
    assert models.resolve(spark, ledger, "champion") == champion["model_path"]
    rows = gold.filter(F.col("timestamp_utc") >= F.lit(dt.datetime(2023, 5, 17))).na.drop()
    for r in records[:-1]:  # stored and loaded, a model scores as before
        out = models.Model(spark, r["model_path"]).score(rows, history=gold)
        got = forecast_metrics_of(out)
        want = metrics.filter(F.col("model") == r["family"]).first()
        assert abs(got["rmse"] - want["rmse"]) < 1e-6 * want["rmse"], r["family"]
    scored = models.score_by_alias(spark, ledger, "anomaly", rows)
    plain = an.detect(rows, nodes, offset, means=means, sample_size=64)
    assert sorted(scored.select("timestamp_utc", "anomaly_score").collect()) == sorted(plain.select("timestamp_utc", "anomaly_score").collect())
    with pytest.raises(models.SignatureMismatch, match="hour is missing"):
        models.score_by_alias(spark, ledger, "anomaly", rows.drop("hour"))
    with pytest.raises(models.SignatureMismatch, match="load_mw_clean_lag_24 is string"):
        models.score_by_alias(spark, ledger, "anomaly", rows.withColumn("load_mw_clean_lag_24", F.lit("x")))
    with pytest.raises(LookupError):
        models.resolve(spark, ledger, "nobody")


def forecast_metrics_of(df):
    from loadcast.operators import evaluate as ev
    return ev.forecast_metrics(ev.mask_valid(df), y="load_mw_clean").first()


def test_a_seasonal_model_is_fitted_once(spark):
    rows = spark.range(400).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as timestamp_utc", "'A' as country",
                                       "100.0 + id % 24 as load_mw_clean")
    coefs, settings = fc.fit_seasonal(rows)
    assert "seasonal" in coefs.inputFiles()[0]
    assert "Range" not in coefs._jdf.queryExecution().optimizedPlan().toString()
    assert fc.predict_seasonal(rows, coefs, settings).filter("abs(prediction - load_mw_clean) > 20").count() == 0


def test_requests_are_built_from_the_registered_gold(spark, monkeypatch):
    from loadcast.queries import q_anomaly as qa
    g = spark.range(3).selectExpr("timestamp_ntz'2024-01-01 00:00:00' as timestamp_utc", "'A' as country",
                                  *[f"cast(id as double) as {f.name}" for f in qa.sc.FORECAST_REQUEST.fields if f.name != "timestamp_utc"])
    monkeypatch.setattr(qa.layers, "gold_grid", lambda *a, **k: pytest.fail("gold was built again"))
    assert qa._forecast_request(spark, "/nowhere", g).count() == 3
