"""Train every forecasting candidate on a gold table and pick a champion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.operators import evaluate as ev
from loadcast.operators import forecast as fc
from loadcast.operators import models

CANDIDATES = ["gbt", "seasonal", "sequence", "seasonal_naive", "mean"]


def train_forecasters(gold_all: DataFrame, test_days: int = 30, gbt_params: dict | None = None,
                      seq_len: int = 168, save_dir: str | None = None):
    """Fit all candidates; a failing candidate is recorded, not raised.

    ``gold_all`` keeps the rows with incomplete lags (the sequence model needs
    the full history); the other candidates use complete rows only.
    With ``save_dir`` every candidate is stored (``models``).
    Returns (metrics with status and champion flag, run records).
    """
    spark = gold_all.sparkSession
    gbt_params = gbt_params or {}
    g = ev.time_split(gold_all, test_days).withColumn("y", F.col("load_mw_clean"))
    gold = g.na.drop(subset=[c for c in g.columns if c.startswith("load_mw_clean_lag_")])
    train, test = gold.filter("split = 'train'"), gold.filter("split = 'test'")
    runs, frames = [], []

    def add(name, params, fit, pred_fn):
        try:
            fitted = fit()
            m = ev.forecast_metrics(ev.mask_valid(pred_fn(fitted))).withColumn("model", F.lit(name)).withColumn("status", F.lit("ok"))
            # one row, kept: a failure is attributed to this candidate, and nothing is scored again
            row = m.first()
            run = {"family": name, "params": params}
            if save_dir:
                run["model_path"] = f"{save_dir}/{name}"
                run["signature"] = models.save_model(spark, name, fitted, run["model_path"], gold)
            frames.append(spark.createDataFrame([row], m.schema))
            runs.append(run)
        except Exception as exc:  # noqa: BLE001 - isolate candidate failures
            frames.append(spark.createDataFrame([(name, f"failed: {type(exc).__name__}")], "model string, status string"))

    add("gbt", gbt_params, lambda: fc.fit_gbt(train, **gbt_params), lambda m: fc.predict(m, test))
    add("seasonal", {"changepoints": 5}, lambda: fc.fit_seasonal(train), lambda m: fc.predict_seasonal(test, *m))
    add("sequence", {"length": seq_len}, lambda: fc.fit_sequence(g.filter("split = 'train'"), length=seq_len),
        lambda m: fc.predict_sequence(m, g).filter("split = 'test'"))
    add("seasonal_naive", {}, lambda: None, lambda m: test.withColumn("prediction", F.col("load_mw_clean_lag_24")))
    add("mean", {}, lambda: train.select(F.avg("y")).first()[0], lambda m: test.withColumn("prediction", F.lit(m).cast("double")))
    metrics = frames[0]
    for f in frames[1:]:
        metrics = metrics.unionByName(f, allowMissingColumns=True)
    if not runs:
        raise RuntimeError("every forecasting candidate failed")
    ok = metrics.filter("status = 'ok'")
    champ = ev.champion_pick(ok, CANDIDATES).first()["model"]  # a handful of candidate rows
    return metrics.withColumn("is_champion", F.coalesce(F.col("model") == F.lit(champ), F.lit(False))), runs


def ledger_records(metrics: DataFrame, runs: list[dict]) -> list[dict]:
    """Ledger records of the candidates that were fitted; the champion's alias."""
    by_name = {r["family"]: r for r in runs}
    rows = metrics.filter("status = 'ok'").select("model", "mape", "rmse", "mae", "is_champion").collect()  # one per candidate
    return [by_name[r["model"]] | {"metrics": {"mape": r["mape"], "rmse": r["rmse"], "mae": r["mae"]},
                                   "alias": "champion" if r["is_champion"] else None} for r in rows]
