"""Rolling-origin evaluation with models refitted per fold.

Fold ``f`` trains on all rows up to cutoff ``f`` and tests on those up to the
next.  Training sets are nested, so nothing is fitted on copies: rows fall in
segments between cutoffs, each segment has its normal equations (one pass,
summed up in tasks), and a fold's equations are the sums of the segments before
it.  The seasonal model is solved per zone where its equations are; the
autoregression is one small system a fold.

Scales are those of the rows before the first cutoff, which every fold knows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.operators import forecast as fc
from loadcast.schemas import TARGET


def cutoffs(df: DataFrame, folds: int = 5, fold_days: int = 30, ts: str = "timestamp_utc") -> list[dt.datetime]:
    """Ends of the training sets, oldest first (the newest time is fetched)."""
    newest = df.agg(F.max(ts)).first()[0]
    return [] if newest is None else [newest - dt.timedelta(days=(folds + 1 - f) * fold_days) for f in range(1, folds + 1)]


def with_segment(df: DataFrame, cuts: Sequence[dt.datetime], ts: str = "timestamp_utc") -> DataFrame:
    """``seg`` = cutoffs before a row: 0 trains every fold, ``f`` tests fold f.
    Rows beyond the last fold's test span do not occur (it ends at the newest)."""
    return df.withColumn("seg", sum((F.col(ts) > F.lit(c).cast("timestamp_ntz")).cast("int") for c in cuts))


def segment_grams(rows: DataFrame, by: str, columns: Sequence[str], y: str) -> DataFrame:
    """``(by, seg, i, row)``: lines of the Gram matrix of (columns..., y)."""
    columns = list(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            m = b.column("x").flatten().to_numpy().reshape(len(b), -1)
            key = pd.MultiIndex.from_arrays([b.column("k").to_pylist(), b.column("seg").to_pylist()])
            for k, at in pd.Series(range(len(b))).groupby([key.get_level_values(0), key.get_level_values(1)]).indices.items():
                g = m[at].T @ m[at]
                yield pa.RecordBatch.from_arrays([pa.array([k[0]] * len(g), pa.string()), pa.array([k[1]] * len(g), pa.int32()), pa.array(range(len(g)), pa.int32()),
                                                  pa.array(list(g), pa.list_(pa.float64()))], ["k", "seg", "i", "row"])

    x = F.array(*[F.col(c).cast("double") for c in columns], F.col(y).cast("double"))
    parts = rows.select(F.col(by).cast("string").alias("k"), "seg", x.alias("x")).mapInArrow(partial, "k string, seg int, i int, row array<double>")
    return parts.groupBy("k", "seg", "i").agg(Summarizer.sum(array_to_vector("row")).alias("v")).select(F.col("k").alias(by), "seg", "i", fc.vector_to_array("v").alias("row"))


def seasonal_folds(df: DataFrame, cuts: Sequence[dt.datetime], target: str = TARGET, ridge: float = 1e-3, by: str = "country", **design) -> DataFrame:
    """Predictions of the seasonal model for every fold's test rows: ``df`` with
    ``seg`` -> its rows of ``seg`` 1 and up with ``prediction``."""
    b = df.agg(F.min("timestamp_utc")).first()[0]
    origin, span = F.lit(b).cast("timestamp_ntz"), F.lit((cuts[0] - b).total_seconds() / 3600)
    rows, names = fc.seasonal_design(df, origin, span, **design)
    grams = segment_grams(rows.filter(F.col(target).isNotNull()), by, names, target)
    p, folds = len(names), len(cuts)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        total, out = np.zeros((p + 1, p + 1)), []
        for f in range(1, folds + 1):
            for _, r in pdf[pdf["seg"] == f - 1].iterrows():
                total[int(r["i"])] += r["row"]
            a, b = total[:p, :p], total[:p, p]
            scale = max(float(np.trace(a)) / p, 1.0)
            out.append((pdf[by].iloc[0], f, np.linalg.solve(a + ridge * scale * np.eye(p), b).tolist()))
        return pd.DataFrame(out, columns=[by, "seg", "coef"])

    coefs = grams.groupBy(by).applyInPandas(solve, f"{by} string, seg int, coef array<double>")
    j = rows.filter("seg >= 1").join(coefs, [by, "seg"], "left")
    return j.withColumn("prediction", sum((F.col("coef")[i] * F.col(n) for i, n in enumerate(names)), F.lit(0.0))).drop("coef", *names)


def sequence_folds(df: DataFrame, cuts: Sequence[dt.datetime], length: int = 168, target: str = TARGET, penalty: float = 1e-3,
                   bucket_steps: int | None = 2016) -> DataFrame:
    """Predictions of the autoregression for every fold's test rows."""
    st = df.filter("seg = 0").agg(F.avg(target).alias("m"), F.stddev_samp(target).alias("s")).first()
    m, s = st["m"], st["s"] or 1.0
    z = df.withColumn("_z", (F.col(target) - F.lit(m)) / F.lit(s))
    seq = fc.sequence_windows(z, "_z", length, bucket_steps=bucket_steps)
    grams = fc.gram_matrices(seq.filter("_z is not null").withColumn("_s", F.col("seg").cast("string")), "_s", "seq", "_z")
    weights, total = {}, 0.0
    for f in range(1, len(cuts) + 1):
        total = total + grams.get(str(f - 1), 0.0)
        if not np.isscalar(total):
            weights[f] = fc.ridge_path(total, None, [penalty])[0][2]

    @F.pandas_udf("double")
    def dot(windows: pd.Series, fold: pd.Series) -> pd.Series:
        out = np.full(len(fold), np.nan)
        for f in fold.unique():
            own = (fold == f).to_numpy()
            if f in weights:
                out[own] = np.stack(windows[own].to_numpy()) @ weights[f][1:] + weights[f][0]
        return pd.Series(out)

    return seq.filter("seg >= 1").withColumn("prediction", dot("seq", "seg") * F.lit(s) + F.lit(m)).drop("seq", "_z")


def rolling_origin(df: DataFrame, folds: int = 5, fold_days: int = 30, length: int = 168, target: str = TARGET) -> DataFrame:
    """``(fold, model, y, prediction)`` of four models; ``df`` is stored gold
    (read once per model)."""
    cuts = cutoffs(df, folds, fold_days)
    g = with_segment(df, cuts).withColumn("y", F.col(target))
    seg = g.groupBy("seg").agg(F.sum(target).alias("s"), F.count(target).alias("c")).collect()  # folds + 1 rows
    mean = {f: sum(r["s"] or 0 for r in seg if r["seg"] < f) / max(1, sum(r["c"] for r in seg if r["seg"] < f)) for f in range(1, folds + 1)}
    means = F.create_map(*[F.lit(x) for k, v in mean.items() for x in (k, float(v))])
    test = g.filter("seg >= 1")
    models = {"seasonal": seasonal_folds(g, cuts, target), "sequence": sequence_folds(g, cuts, length, target),
              "seasonal_naive": test.withColumn("prediction", F.col(f"{target}_lag_24")), "mean": test.withColumn("prediction", means[F.col("seg")])}
    out = None
    for name, p in models.items():
        own = p.select(F.col("seg").alias("fold"), F.lit(name).alias("model"), "y", "prediction")
        out = own if out is None else out.unionByName(own)
    return out
