"""M7 forecasting: matrices, scaling, sequences, model fits and ledgers."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.functions.timecols import epoch_hours
from loadcast.operators import backtest as bt
from loadcast.operators import evaluate as ev
from loadcast.operators import features as feat
from loadcast.operators import forecast as fc
from loadcast.operators import ledger as lg
from loadcast.operators.training import ledger_records
from loadcast.plans import layers
from loadcast.present import finish
from loadcast.registry import query
from loadcast.schemas import ANOMALY_FEATURES, FEATURE_COLS
from loadcast.session import work_dir

W = O.with_
R = O.rnd
SILVER = O.silver_ctes()
GOLD = SILVER + O.gold_ctes()
TEST_DAYS = 7
CUT = f"(SELECT max(timestamp_utc) - INTERVAL {TEST_DAYS} DAY FROM gold)"
# Small boosting settings keep the check fast; jobs use the full ones.
GBT_QUICK = dict(max_iter=10, max_depth=4, step_size=0.1, min_instances=20, seed=42)


def split(spark, sf_dir):
    g = ev.time_split(layers.gold_table(spark, sf_dir), TEST_DAYS).withColumn("y", F.col("load_mw_clean"))
    return g.filter("split = 'train'"), g.filter("split = 'test'")


@query("forecast_matrix", W(*GOLD) + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS label, CAST({len(FEATURE_COLS)} AS BIGINT) AS n_features,
       {R(' + '.join(f'CAST({c} AS DOUBLE)' for c in FEATURE_COLS))} AS feature_sum
FROM gold WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURE_COLS)}""")
def forecast_matrix(spark, sf_dir):
    m = fc.forecast_matrix(layers.gold_grid(spark, sf_dir))
    arr = vector_to_array("features")
    return finish(m.select("timestamp_utc", "country", "label", F.size(arr).cast("bigint").alias("n_features"),
                           F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("feature_sum")))


_Z = ["load_mw_clean", "load_mw_clean_lag_24"]


@query("standardize", W(*GOLD, ("train", f"SELECT * FROM gold WHERE timestamp_utc <= {CUT}")) + "\nSELECT timestamp_utc, country, "
       + ", ".join(f"{R(f'({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_samp({c}) FROM train)')} AS {c}_z" for c in _Z)
       + " FROM gold")
def standardize(spark, sf_dir):
    """Scaler fitted on train rows (sample std), applied to every row."""
    g = layers.gold_grid(spark, sf_dir)
    train = g.filter(F.col("timestamp_utc") <= ev.cutoff(g, TEST_DAYS))
    out = fc.standardize(g, _Z, fc.standardize_stats(train, _Z))
    return finish(out.select("timestamp_utc", "country", *[f"{c}_z" for c in _Z]))


SEQ_L = 168
_FR = f"PARTITION BY country, kind ORDER BY timestamp_utc ROWS BETWEEN {SEQ_L} PRECEDING AND 1 PRECEDING"


@query("sequence_windows", W(*SILVER, ("s", f"""SELECT timestamp_utc, country, load_mw_clean,
  count(load_mw_clean) OVER ({_FR}) AS n, first_value(load_mw_clean) OVER ({_FR}) AS f, last_value(load_mw_clean) OVER ({_FR}) AS l,
  sum(load_mw_clean) OVER ({_FR}) AS t FROM silver""")) + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS y, CAST(n AS BIGINT) AS seq_len, {R('f')} AS seq_first, {R('l')} AS seq_last, {R('t')} AS seq_sum
FROM s WHERE n = {SEQ_L}""")
def sequence_windows(spark, sf_dir):
    s = fc.sequence_windows(layers.silver_grid(spark, sf_dir), "load_mw_clean", SEQ_L)
    return finish(s.select("timestamp_utc", "country", F.col("load_mw_clean").alias("y"),
                           F.size("seq").cast("bigint").alias("seq_len"), F.col("seq")[0].alias("seq_first"),
                           F.element_at("seq", -1).alias("seq_last"),
                           F.aggregate("seq", F.lit(0.0), lambda a, x: a + x).alias("seq_sum")))


@query("rename_trend_input", W(*GOLD) + f"\nSELECT timestamp_utc AS ds, {R('load_mw_clean')} AS y, country FROM gold")
def rename_trend_input(spark, sf_dir):
    return finish(fc.rename_trend_input(layers.gold_grid(spark, sf_dir)))


def _gbt(spark, sf_dir):
    train, test = split(spark, sf_dir)
    model = fc.fit_gbt(train, **GBT_QUICK)
    return model, train, test


@query("fit_gbt")
def fit_gbt(spark, sf_dir):
    model, _, _ = _gbt(spark, sf_dir)
    m = model.stages[-1]
    return spark.createDataFrame([(m.getNumTrees, m.totalNumNodes, m.numFeatures)],
                                 "num_trees int, total_nodes int, num_features int")


@query("predict_gbt")
def predict_gbt(spark, sf_dir):
    model, _, test = _gbt(spark, sf_dir)
    return finish(fc.predict(model, test).select("timestamp_utc", "country", "y", "prediction"))


@query("evaluate_gbt")
def evaluate_gbt(spark, sf_dir):
    model, _, test = _gbt(spark, sf_dir)
    return finish(ev.forecast_metrics(fc.predict(model, test)))


@query("gbt_importance")
def gbt_importance(spark, sf_dir):
    model, _, _ = _gbt(spark, sf_dir)
    return finish(fc.gbt_importance(spark, model))


@query("importance_rank")
def importance_rank(spark, sf_dir):
    model, _, _ = _gbt(spark, sf_dir)
    return finish(fc.importance_rank(fc.gbt_importance(spark, model)))


@query("fit_seasonal")
def fit_seasonal(spark, sf_dir):
    """Per-zone additive seasonal model; test metrics per zone."""
    train, test = split(spark, sf_dir)
    coefs, settings = fc.fit_seasonal(train)
    pred = fc.predict_seasonal(test, coefs, settings)
    return finish(ev.forecast_metrics(pred, by=["country"]))


@query("fit_sequence")
def fit_sequence(spark, sf_dir):
    """AR(168) on standardised sequence windows; the penalty that the tail of
    each training series chose, and metrics on the test rows."""
    g = ev.time_split(layers.gold_table(spark, sf_dir, drop=False), TEST_DAYS).withColumn("y", F.col("load_mw_clean"))
    fitted = fc.fit_sequence(g.filter("split = 'train'"), length=SEQ_L)
    pred = fc.predict_sequence(fitted, g).filter("split = 'test'")
    chosen = dict(fitted["path"])[fitted["penalty"]]
    return finish(ev.forecast_metrics(ev.mask_valid(pred), by=["country"])
                  .withColumn("penalty", F.lit(fitted["penalty"])).withColumn("validation_rmse", F.lit(chosen).cast("double")))


@query("sequence_validation", W(*SILVER, ("cut", f"SELECT max(timestamp_utc) - INTERVAL {TEST_DAYS} DAY AS c FROM silver"), ("s", f"""SELECT timestamp_utc, country, kind, load_mw_clean,
  count(load_mw_clean) OVER ({_FR}) AS n FROM silver, cut WHERE timestamp_utc <= c"""),
                                ("w", f"""SELECT *, row_number() OVER (PARTITION BY country, kind ORDER BY timestamp_utc) AS r,
  count(*) OVER (PARTITION BY country, kind) AS k FROM s WHERE n = {SEQ_L} AND load_mw_clean IS NOT NULL"""))
       + """
SELECT CAST(sum(CASE WHEN r <= floor(0.9 * k) THEN 1 ELSE 0 END) AS BIGINT) AS n_train, CAST(sum(CASE WHEN r > floor(0.9 * k) THEN 1 ELSE 0 END) AS BIGINT) AS n_validation,
       true AS least_error, true AS path_is_whole FROM w""")
def sequence_validation(spark, sf_dir):
    """Rows on either side of the 90/10 tail split, and whether the chosen
    penalty is the path's best."""
    g = ev.time_split(layers.materialize(layers.silver_grid(spark, sf_dir), "silver"), TEST_DAYS)
    fitted = fc.fit_sequence(g.filter("split = 'train'").drop("split"), length=SEQ_L)
    errors = dict(fitted["path"])
    return spark.createDataFrame([(fitted["n_train"], fitted["n_validation"], errors[fitted["penalty"]] == min(errors.values()), len(errors) == len(fc.PENALTIES))],
                                 "n_train long, n_validation long, least_error boolean, path_is_whole boolean")


_H = 24
_H_LAGS = [k for k in (1, 24, 48, 168) if k >= _H]
_H_COLS = [f"load_mw_clean_lag_{k}" for k in _H_LAGS] + [f"load_mw_clean_roll_{s}_{w}" for w in (24, 168) for s in ("mean", "std")]


@query("horizon_24", W(*SILVER, ("f", f"SELECT *, {O.lags_rolls_sql(horizon=_H)} FROM silver"))
       + "\nSELECT timestamp_utc, country, " + ", ".join(f"{R(c)} AS {c}" for c in _H_COLS) + " FROM f")
def horizon_24(spark, sf_dir):
    """24-hour-ahead features: lags >= 24 and rolls ending 24 rows back."""
    out = feat.add_lags_rolls(layers.silver_grid(spark, sf_dir), horizon=_H, bucket_steps=2016, dense=True)
    return finish(out.select("timestamp_utc", "country", *_H_COLS))


FOLDS, FOLD_DAYS = 5, 2


def _cv_sql():
    cut = lambda f: f"((SELECT max(timestamp_utc) FROM gold) - INTERVAL {(FOLDS + 1 - f) * FOLD_DAYS} DAY)"
    parts = []
    for f in range(1, FOLDS + 1):
        test = f"timestamp_utc > {cut(f)} AND timestamp_utc <= {cut(f)} + INTERVAL {FOLD_DAYS} DAY"
        mean = f"(SELECT avg(load_mw_clean) FROM gold WHERE timestamp_utc <= {cut(f)})"
        parts.append(f"SELECT {f} AS fold, 'mean' AS model, load_mw_clean AS y, {mean} AS p FROM gold WHERE {test}")
        parts.append(f"SELECT {f}, 'seasonal_naive', load_mw_clean, load_mw_clean_lag_24 FROM gold WHERE {test}")
    body = " UNION ALL ".join(parts)
    return W(*GOLD, ("cv", body)) + f"""
SELECT CAST(fold AS BIGINT) AS fold, model, {R('avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16))')} AS mape,
       {R('sqrt(avg((y - p) * (y - p)))')} AS rmse, {R('avg(abs(y - p))')} AS mae, count(*) AS n
FROM cv GROUP BY fold, model"""


@query("rolling_origin_cv", _cv_sql())
def rolling_origin_cv(spark, sf_dir):
    """Five time-ordered folds of 2 days; training means from prefix sums of
    per-segment aggregates (no row is copied per fold)."""
    g = layers.gold_table(spark, sf_dir)
    g = bt.with_segment(g, bt.cutoffs(g, FOLDS, FOLD_DAYS))
    agg = g.groupBy("seg").agg(F.sum("load_mw_clean").alias("s"), F.count("load_mw_clean").alias("c"))
    w = Window.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    means = agg.select(F.col("seg").alias("fold"), (F.sum("s").over(w) / F.sum("c").over(w)).alias("train_mean"))
    test = g.filter(F.col("seg") >= 1).withColumnRenamed("seg", "fold").withColumn("y", F.col("load_mw_clean"))
    mean_pred = test.join(means, "fold").withColumn("prediction", F.col("train_mean")).withColumn("model", F.lit("mean"))
    naive = test.withColumn("prediction", F.col("load_mw_clean_lag_24")).withColumn("model", F.lit("seasonal_naive"))
    cols = ["fold", "model", "y", "prediction"]
    both = mean_pred.select(*cols).unionByName(naive.select(*cols))
    return finish(ev.forecast_metrics(both, by=["fold", "model"]))


@query("rolling_origin_refits")
def rolling_origin_refits(spark, sf_dir):
    """Five folds, four models, each refitted from the sums before its cutoff."""
    pred = bt.rolling_origin(layers.gold_table(spark, sf_dir, drop=False), FOLDS, FOLD_DAYS, SEQ_L)
    return finish(ev.forecast_metrics(ev.mask_valid(pred), by=["fold", "model"]))


def _sums_sql():
    cut = lambda f: f"((SELECT max(timestamp_utc) FROM gold) - INTERVAL {(FOLDS + 1 - f) * FOLD_DAYS} DAY)"
    seg = " + ".join(f"CAST(timestamp_utc > {cut(f)} AS INTEGER)" for f in range(1, FOLDS + 1))
    x = "sin(2 * pi() * (epoch(timestamp_utc) / 3600) / 24)"
    return W(*GOLD, ("s", f"SELECT country, {seg} AS seg, load_mw_clean AS y, {x} AS x FROM gold WHERE load_mw_clean IS NOT NULL")) + f"""
SELECT country, CAST(seg AS BIGINT) AS seg, CAST(count(*) AS DOUBLE) AS n, {R('sum(y)')} AS sum_y, {R('sum(y * y)')} AS sum_yy, {R('sum(x * x)')} AS sum_xx, {R('sum(x * y)')} AS sum_xy
FROM s GROUP BY country, seg"""


@query("rolling_origin_sums", _sums_sql())
def rolling_origin_sums(spark, sf_dir):
    """Normal equations of (1, daily sine) per zone and segment."""
    g = layers.gold_table(spark, sf_dir)
    g = bt.with_segment(g, bt.cutoffs(g, FOLDS, FOLD_DAYS)).filter("load_mw_clean is not null")
    g = g.withColumns({"one": F.lit(1.0), "x": F.sin(F.lit(2 * math.pi / 24) * epoch_hours("timestamp_utc"))})
    m = bt.segment_grams(g, "country", ["one", "x"], "load_mw_clean")
    at = lambda i, j: F.max(F.when(F.col("i") == i, F.col("row")[j]))
    return finish(m.groupBy("country", "seg").agg(at(0, 0).alias("n"), at(0, 2).alias("sum_y"), at(2, 2).alias("sum_yy"), at(1, 1).alias("sum_xx"), at(1, 2).alias("sum_xy")))


def train_forecasters_df(spark, sf_dir, gbt_params=None, seq_len=SEQ_L, save_dir=None):
    from loadcast.operators.training import train_forecasters as tf
    return tf(layers.gold_table(spark, sf_dir, drop=False), TEST_DAYS, gbt_params or GBT_QUICK, seq_len, save_dir)


@query("train_forecasters")
def train_forecasters(spark, sf_dir):
    m, _ = train_forecasters_df(spark, sf_dir)
    return finish(m.select("model", "status", "mape", "rmse", "mae", "n", "is_champion"))


@query("model_ledger")
def model_ledger(spark, sf_dir):
    """Append one ledger row per candidate (params, metrics, alias) and read it back."""
    m, runs = train_forecasters_df(spark, sf_dir)
    recs = ledger_records(m, runs)
    path = lg.append_ledger(lg.ledger_rows(spark, recs), work_dir(spark, "ledger"))
    led = spark.read.parquet(path)
    return led.select("family", "alias", F.col("metrics")["mape"].alias("mape"),
                      F.to_json("params").alias("params"))


def _signature_sql():
    """Every feature with its fixed type; the last one arrives as text."""
    parts = []
    for f in FEATURE_COLS:
        kind = "double" if f.startswith("load_mw") or f.endswith(("_sin", "_cos")) else "bigint"
        last = f == FEATURE_COLS[-1]
        parts.append(f"SELECT '{f}' AS \"column\", '{kind}' AS expected, '{'string' if last else kind}' AS actual, true AS present, "
                     f"{str(not last).lower()} AS ok, count({f}) AS n_usable, count(*) AS n_rows FROM gold")
    return W(*GOLD) + "\n" + "\nUNION ALL ".join(parts)


@query("signature_check", _signature_sql())
def signature_check(spark, sf_dir):
    """Signature stored at training time vs the columns of a scoring batch."""
    g = layers.gold_grid(spark, sf_dir)
    stored = lg.signature(g, FEATURE_COLS)
    batch = g.select(*FEATURE_COLS[:-1], F.col(FEATURE_COLS[-1]).cast("string"))
    return lg.signature_check(batch, stored)


__all__ = ["ANOMALY_FEATURES"]
