"""Forecasting on Spark: matrices, scaling, sequence windows and three model
families (MLlib gradient-boosted trees, a per-zone additive seasonal model,
an autoregressive sequence model)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: F401  (the latter re-exported)
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions.timecols import epoch_hours
from loadcast.operators.evaluate import tail_fraction_split
from loadcast.plans.halo import series_window
from loadcast.schemas import FEATURE_COLS, TARGET
from loadcast.session import work_dir


# ---------------------------------------------------------------- matrices

def assembler(features: Sequence[str] = tuple(FEATURE_COLS), out: str = "features",
              handle_invalid: str = "skip") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=handle_invalid)


def forecast_matrix(df: DataFrame, features: Sequence[str] = tuple(FEATURE_COLS), label: str = TARGET) -> DataFrame:
    """Feature vector + label; rows with a missing feature are skipped."""
    return assembler(features).transform(df.withColumn("label", F.col(label).cast("double")))


def standardize_stats(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and sample std per column, fitted on training rows (one row)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    return train.agg(*aggs)


def standardize(df: DataFrame, cols: Sequence[str], stats: DataFrame, suffix: str = "_z") -> DataFrame:
    """(x - mean) / std with the fitted training statistics (one row, fetched
    once like any fitted model parameter)."""
    st = stats.first()
    out = {}
    for c in cols:
        m, s = F.lit(st[f"{c}__mean"]).cast("double"), F.lit(st[f"{c}__std"]).cast("double")
        out[f"{c}{suffix}"] = (F.col(c) - m) / F.when(s > 0, s).otherwise(F.lit(1.0))
    return df.withColumns(out)


def sequence_windows(df: DataFrame, value: str, length: int, out: str = "seq",
                     bucket_steps: int | None = 2016, dense: bool = False) -> DataFrame:
    """Previous ``length`` values as an array (oldest first); rows without a
    full window are dropped.  Nulls must be imputed before (collect_list
    skips them)."""
    def cols(w):
        return {out: F.collect_list(value).over(w.rowsBetween(-length, -1))}
    seq = series_window(df, cols, lookback=length, bucket_steps=bucket_steps, dense=dense)
    return seq.filter(F.size(out) == length)


def rename_trend_input(df: DataFrame, ts: str = "timestamp_utc", target: str = TARGET) -> DataFrame:
    """(ds, y) naming of a trend model; ds is a zone-less UTC wall clock."""
    return df.select(F.col(ts).cast("timestamp_ntz").alias("ds"), F.col(target).alias("y"), "country")


# ---------------------------------------------------------------- boosting

def gbt_pipeline(features: Sequence[str] = tuple(FEATURE_COLS), max_iter: int = 500, step_size: float = 0.05,
                 max_depth: int = 6, min_instances: int = 20, seed: int = 42, subsample: float = 1.0) -> Pipeline:
    """Depth-wise MLlib boosting standing in for a leaf-wise learner
    (64 leaves ~ depth 6); no L1/L2 terms in MLlib."""
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, stepSize=step_size,
                       maxDepth=max_depth, minInstancesPerNode=min_instances, seed=seed,
                       subsamplingRate=subsample)
    return Pipeline(stages=[assembler(features), gbt])


def _labelled(df: DataFrame, label: str) -> DataFrame:
    """Training rows need a label: NULL / NaN targets are dropped."""
    return df.withColumn("label", F.col(label).cast("double")).filter(F.col("label").isNotNull() & ~F.isnan("label"))


def fit_gbt(train: DataFrame, label: str = TARGET, **params) -> PipelineModel:
    return gbt_pipeline(**params).fit(_labelled(train, label))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every row of ``df``; rows with a missing feature have a NULL prediction."""
    if model is None:
        raise RuntimeError("model is not fitted")
    stages = [s.copy({s.handleInvalid: "keep"}) if isinstance(s, VectorAssembler) else s for s in model.stages]
    missing = F.lit(False)
    for c in [c for s in stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]:
        missing = missing | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    scored = PipelineModel(stages).transform(df)
    return scored.withColumn("prediction", F.when(~missing, F.col("prediction"))).drop("features")


def gbt_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str] = tuple(FEATURE_COLS)) -> DataFrame:
    """(feature, importance) — the model's vector has one entry per feature."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")


def importance_rank(imp: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))
    return imp.withColumn("rank", F.row_number().over(w))


# ---------------------------------------------------------------- seasonal additive model

def seasonal_design(df: DataFrame, origin: Column, span_hours: Column, ts: str = "timestamp_utc",
                    changepoints: int = 5, daily: int = 3, weekly: int = 3, yearly: int = 2) -> tuple[DataFrame, list[str]]:
    """Trend (intercept, t, hinges at evenly spaced changepoints) + Fourier
    terms for daily, weekly and yearly seasonality (additive model).

    ``origin`` / ``span_hours`` may be scalar subqueries: they are bound to a
    column once, so each is evaluated once."""
    df = df.withColumns({"_origin_h": epoch_hours(origin).cast("double"), "_span_h": F.greatest(span_hours, F.lit(1.0))})
    h = epoch_hours(ts).cast("double")
    t = (h - F.col("_origin_h")) / F.col("_span_h")
    cols = {"x_int": F.lit(1.0), "x_t": t}
    for j in range(1, changepoints + 1):
        c = 0.8 * j / (changepoints + 1)
        cols[f"x_cp{j}"] = F.greatest(t - F.lit(c), F.lit(0.0))
    for name, period, order in (("d", 24.0, daily), ("w", 168.0, weekly), ("y", 8766.0, yearly)):
        for k in range(1, order + 1):
            ang = F.lit(2 * math.pi * k / period) * h
            cols[f"x_{name}s{k}"] = F.sin(ang)
            cols[f"x_{name}c{k}"] = F.cos(ang)
    return df.withColumns(cols).drop("_origin_h", "_span_h"), list(cols)


def fit_seasonal(train: DataFrame, target: str = TARGET, ridge: float = 1e-3, by: str = "country",
                 **design) -> tuple[DataFrame, dict]:
    """Least squares per zone from aggregated normal equations.

    X'X and X'y are sums (map-side partial aggregation, one row per zone);
    the small p x p system of each zone is solved in ``applyInPandas``.
    Returns (coefficients per zone, design settings for prediction).
    """
    # the trend scale is fitted once on the training rows (two scalars, then kept)
    b = train.agg(F.min("timestamp_utc").alias("o"),
                  (epoch_hours(F.max("timestamp_utc")) - epoch_hours(F.min("timestamp_utc"))).cast("double").alias("s")).first()
    origin, span = F.lit(b["o"]).cast("timestamp_ntz"), F.lit(b["s"])
    X, names = seasonal_design(train.filter(F.col(target).isNotNull()), origin, span, **design)
    p = len(names)
    aggs = []
    for i in range(p):
        for j in range(i, p):
            aggs.append(F.sum(F.col(names[i]) * F.col(names[j])).alias(f"a_{i}_{j}"))
        aggs.append(F.sum(F.col(names[i]) * F.col(target)).alias(f"b_{i}"))
    ne = X.groupBy(by).agg(*aggs, F.count(F.lit(1)).alias("n"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            A = np.zeros((p, p))
            b = np.zeros(p)
            for i in range(p):
                b[i] = r[f"b_{i}"]
                for j in range(i, p):
                    A[i, j] = A[j, i] = r[f"a_{i}_{j}"]
            scale = max(float(np.trace(A)) / p, 1.0)
            coef = np.linalg.solve(A + ridge * scale * np.eye(p), b)
            rows.append((r[by], [float(c) for c in coef]))
        return pd.DataFrame(rows, columns=[by, "coef"])

    # One row per zone, stored: whoever scores or saves the model would fit it again.
    path, schema = work_dir(train.sparkSession, "seasonal"), f"{by} string, coef array<double>"
    ne.groupBy(by).applyInPandas(solve, schema=schema).write.parquet(path)
    return train.sparkSession.read.schema(schema).parquet(path), {"origin": origin, "span": span, "names": names, "design": design}


def predict_seasonal(df: DataFrame, coefs: DataFrame, settings: dict, by: str = "country") -> DataFrame:
    X, names = seasonal_design(df, settings["origin"], settings["span"], **settings["design"])
    # one coefficient row per zone: AQE broadcasts it once its size is measured
    j = X.join(coefs, by, "left")
    pred = sum((F.col("coef")[i] * F.col(n) for i, n in enumerate(names)), F.lit(0.0))
    return j.withColumn("prediction", pred).drop("coef", *names)


# ---------------------------------------------------------------- sequence (autoregressive) model

PENALTIES = (0.0, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0)


def gram_matrices(seq: DataFrame, split: str, x: str, y: str) -> dict[str, np.ndarray]:
    """Per value of ``split``: the Gram matrix of (1, x..., y), summed up over
    tasks; a task sends one row per line of the matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            if not len(b):
                continue
            m = np.column_stack((np.ones(len(b)), b.column("x").flatten().to_numpy().reshape(len(b), -1), b.column("y").to_numpy()))
            names = np.array(b.column("s").to_pylist())
            for s in np.unique(names):
                own = m[names == s]
                sums[s] = sums.get(s, 0.0) + own.T @ own
        for s, g in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([s] * len(g)), pa.array(range(len(g)), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))], ["s", "i", "row"])

    parts = seq.select(F.col(split).alias("s"), F.col(x).alias("x"), F.col(y).cast("double").alias("y")).mapInArrow(partial, "s string, i int, row array<double>")
    total = parts.groupBy("s", "i").agg(Summarizer.sum(array_to_vector("row")).alias("row"))
    out: dict[str, list] = {}
    for r in total.orderBy("s", "i").collect():  # two matrices of (window + 2) lines
        out.setdefault(r["s"], []).append(r["row"].toArray())
    return {s: np.array(g) for s, g in out.items()}


def ridge_path(train: np.ndarray, validation: np.ndarray | None, penalties: Sequence[float]) -> list[tuple[float, float | None, np.ndarray]]:
    """``(penalty, validation RMSE, weights)`` along the path, all from Gram
    matrices of (1, x..., y); the intercept is not penalised."""
    g, b, n = train[:-1, :-1], train[:-1, -1], train[0, 0]
    out = []
    for p in penalties:
        w = np.linalg.lstsq(g + p * n * np.diag([0.0] + [1.0] * (len(g) - 1)), b, rcond=None)[0]
        error = None
        if validation is not None:
            u = np.append(w, -1.0)
            error = math.sqrt(max(0.0, u @ validation @ u) / validation[0, 0])
        out.append((p, error, w))
    return out


def fit_sequence(train: DataFrame, length: int = 168, target: str = TARGET, penalties: Sequence[float] = PENALTIES,
                 validation: float = 0.1, bucket_steps: int | None = 2016) -> dict:
    """Next value from the previous ``length`` standardised values: a ridge
    autoregression.  The last ``validation`` of each series chooses the penalty;
    the weights are then solved from all training rows.  One pass over the
    sequence windows: everything follows from two Gram matrices."""
    stats = standardize_stats(train, [target]).first()
    stats = train.sparkSession.createDataFrame([tuple(stats)], train.agg(F.avg(target).alias(f"{target}__mean"), F.stddev_samp(target).alias(f"{target}__std")).schema)
    z = standardize(train, [target], stats)
    seq = sequence_windows(z, f"{target}_z", length, bucket_steps=bucket_steps).filter(F.col(f"{target}_z").isNotNull())
    seq = tail_fraction_split(seq, 1 - validation, by=("country", "kind"))
    grams = gram_matrices(seq, "split", "seq", f"{target}_z")
    if "train" not in grams:
        raise ValueError(f"no series has more than {length} rows")
    path = ridge_path(grams["train"], grams.get("validation"), penalties)
    best = min(path, key=lambda r: (math.inf if r[1] is None else r[1], r[0]))
    weights = ridge_path(sum(grams.values()), None, [best[0]])[0][2]
    return {"intercept": float(weights[0]), "coef": [float(w) for w in weights[1:]], "penalty": best[0], "path": [(p, e) for p, e, _ in path],
            "stats": stats, "length": length, "target": target, "bucket_steps": bucket_steps,
            "n_train": int(grams["train"][0, 0]), "n_validation": int(grams["validation"][0, 0]) if "validation" in grams else 0}


def predict_sequence(fitted: dict, df: DataFrame) -> DataFrame:
    """Predictions for rows with a full window; the first L rows of each
    series keep a NULL prediction."""
    target, length = fitted["target"], fitted["length"]
    z = standardize(df, [target], fitted["stats"])
    seq = sequence_windows(z, f"{target}_z", length, bucket_steps=fitted["bucket_steps"])
    coef, intercept = np.array(fitted["coef"]), fitted["intercept"]

    @F.pandas_udf("double")
    def dot(windows: pd.Series) -> pd.Series:
        return pd.Series(np.stack(windows.to_numpy()) @ coef + intercept if len(windows) else [], dtype=float)

    st = fitted["stats"].first()
    m, s = F.lit(st[f"{target}__mean"]).cast("double"), F.lit(st[f"{target}__std"]).cast("double")
    scored = seq.withColumn("prediction", dot("seq") * F.when(s > 0, s).otherwise(F.lit(1.0)) + m)
    keys = ["timestamp_utc", "country", "kind"]
    return df.join(scored.select(*keys, "prediction"), keys, "left")
