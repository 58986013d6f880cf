"""Isolation forest (Liu, Ting & Zhou 2008) as Spark jobs.

fit:   every row draws a uniform hash per tree; rows under a per-tree
       inclusion probability (sized so each tree gets >= ``sample_size``
       candidates) are emitted for that tree only.  ``groupBy(tree)``
       + ``applyInPandas`` keeps the ``sample_size`` smallest hashes and grows
       one random tree per group.  No task ever sees more than
       ~3 x sample_size rows, whatever the table size.
score: the forest (trees x <= 2*sample_size-1 nodes) is broadcast and path
       lengths are computed batch-wise in ``mapInPandas`` with NumPy.
       score = -2^(-E[h]/c(psi)); decision = score - offset, where offset is
       the contamination quantile of the training scores; anomaly <=> decision < 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.stats import c_factor
from loadcast.schemas import ANOMALY_FEATURES

NODE_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, left int, right int, "
               "size int, depth int")


def impute_means(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column means of the training rows (NaN counted as missing): one row."""
    return train.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in cols])


def impute(df: DataFrame, cols: Sequence[str], means: DataFrame) -> DataFrame:
    """Fill NULL/NaN with the training means (scalar subqueries), so a score
    never depends on which rows share its batch."""
    m = means.first()  # one row of fitted means
    return df.withColumns({c: F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(m[c]).cast("double")) for c in cols})


def _grow(pdf: pd.DataFrame, features: list[str], sample_size: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree_id"].iloc[0])
    pdf = pdf.nsmallest(sample_size, "_u")
    X = pdf[features].to_numpy(dtype=float)
    rng = np.random.default_rng([seed, tree])
    limit = int(math.ceil(math.log2(max(len(X), 2))))
    nodes = []  # (node_id, feature, threshold, left, right, size, depth)
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        nid, idx, depth = stack.pop()
        if depth >= limit or len(idx) <= 1:
            nodes.append((nid, -1, 0.0, -1, -1, len(idx), depth))
            continue
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            nodes.append((nid, -1, 0.0, -1, -1, len(idx), depth))
            continue
        f = int(rng.choice(cand))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        left, right = next_id, next_id + 1
        next_id += 2
        nodes.append((nid, f, thr, left, right, len(idx), depth))
        stack.append((left, idx[go_left], depth + 1))
        stack.append((right, idx[~go_left], depth + 1))
    out = pd.DataFrame(nodes, columns=["node_id", "feature", "threshold", "left", "right", "size", "depth"])
    out.insert(0, "tree_id", tree)
    return out


def fit_forest(df: DataFrame, features: Sequence[str] = tuple(ANOMALY_FEATURES), n_trees: int = 200,
               sample_size: int = 256, seed: int = 42, key: Sequence[str] = ("timestamp_utc", "country")) -> DataFrame:
    """Grow ``n_trees`` isolation trees on rows without missing features.
    Returns the node table (tree_id, node_id, feature, threshold, ...)."""
    features = list(features)
    clean = df.na.drop(subset=features).select(*key, *[F.col(c).cast("double") for c in features])
    n = clean.select(F.count(F.lit(1))).scalar()
    p = F.least(F.lit(1.0), F.lit(3.0 * sample_size + 64.0) / n)

    def u(t):
        h = F.xxhash64(*[F.col(k) for k in key], t, F.lit(seed))
        return (F.pmod(h, F.lit(1 << 40)).cast("double")) / F.lit(float(1 << 40))

    # the inclusion probability is projected first: lambdas cannot hold subqueries
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: u(t) < F.col("_p"))
    cand = (clean.withColumn("_p", p).withColumn("_t", F.explode(trees))
            .select(F.col("_t").alias("tree_id"), u(F.col("_t")).alias("_u"), *features))
    return cand.groupBy("tree_id").applyInPandas(
        lambda pdf: _grow(pdf, features, sample_size, seed), schema=NODE_SCHEMA)


class Forest:
    """Dense arrays of a node table, for vectorised path lengths."""

    def __init__(self, nodes: pd.DataFrame, sample_size: int):
        nodes = nodes.sort_values(["tree_id", "node_id"])
        self.trees = sorted(nodes["tree_id"].unique().tolist())
        size = int(nodes["node_id"].max()) + 1
        T = len(self.trees)
        self.feature = np.full((T, size), -1, dtype=np.int64)
        self.threshold = np.zeros((T, size))
        self.left = np.zeros((T, size), dtype=np.int64)
        self.right = np.zeros((T, size), dtype=np.int64)
        self.leaf_h = np.zeros((T, size))
        pos = {t: i for i, t in enumerate(self.trees)}
        ti = nodes["tree_id"].map(pos).to_numpy()
        ni = nodes["node_id"].to_numpy()
        self.feature[ti, ni] = nodes["feature"].to_numpy()
        self.threshold[ti, ni] = nodes["threshold"].to_numpy()
        self.left[ti, ni] = nodes["left"].to_numpy()
        self.right[ti, ni] = nodes["right"].to_numpy()
        leaf_sizes = nodes["size"].to_numpy()
        self.leaf_h[ti, ni] = nodes["depth"].to_numpy() + np.array([c_factor(s) for s in leaf_sizes])
        self.depth = int(nodes["depth"].max()) + 1
        self.cn = c_factor(sample_size)

    def score(self, X: np.ndarray) -> np.ndarray:
        n = X.shape[0]
        total = np.zeros(n)
        rows = np.arange(n)
        for t in range(len(self.trees)):
            node = np.zeros(n, dtype=np.int64)
            for _ in range(self.depth):
                f = self.feature[t, node]
                internal = f >= 0
                if not internal.any():
                    break
                x = X[rows, np.where(internal, f, 0)]
                nxt = np.where(x < self.threshold[t, node], self.left[t, node], self.right[t, node])
                node = np.where(internal, nxt, node)
            total += self.leaf_h[t, node]
        return -np.power(2.0, -(total / len(self.trees)) / self.cn)


def score_samples(df: DataFrame, nodes: DataFrame, features: Sequence[str] = tuple(ANOMALY_FEATURES),
                  sample_size: int = 256, out: str = "raw_score") -> DataFrame:
    """Add the isolation score (higher = more normal) to complete-feature rows."""
    features = list(features)
    # the forest has at most n_trees * (2 * sample_size - 1) nodes: bounded, broadcast to every task
    node_pdf = nodes.toPandas()
    sc = df.sparkSession.sparkContext
    bc = sc.broadcast(node_pdf)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        forest = Forest(bc.value, sample_size)
        for columns in parts:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(forest.score(x) if len(x) else [], dtype=float)

    return df.withColumn(out, score(*[F.col(c).cast("double") for c in features]))


def fit_offset(train_scored: DataFrame, contamination: float = 0.01, col: str = "raw_score") -> float:
    """The contamination quantile of training scores (a fitted threshold)."""
    return float(train_scored.select(F.percentile_approx(col, contamination, 100000)).first()[0])


def detect(df: DataFrame, nodes: DataFrame, offset, features: Sequence[str] = tuple(ANOMALY_FEATURES),
           means: DataFrame | None = None, sample_size: int = 256) -> DataFrame:
    """anomaly_score (decision function) and is_anomaly per row."""
    x = impute(df, features, means) if means is not None else df
    s = score_samples(x, nodes, features, sample_size)
    return (s.withColumn("anomaly_score", F.col("raw_score") - F.lit(offset))
            .withColumn("is_anomaly", (F.col("anomaly_score") < 0).cast("bigint")))


def anomaly_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.sum("is_anomaly").alias("n_anomalies"), F.avg("is_anomaly").alias("anomaly_rate"),
                      F.min("anomaly_score").alias("score_min"), F.max("anomaly_score").alias("score_max"),
                      F.count(F.lit(1)).alias("n_rows"))


def train_anomaly(df: DataFrame, features: Sequence[str] = tuple(ANOMALY_FEATURES), n_trees: int = 200,
                  sample_size: int = 256, contamination: float = 0.01, seed: int = 42):
    """Fit on complete rows; score every row with training-mean imputation.
    Returns (scored rows, node table, means, offset)."""
    features = list(features)
    train = df.na.drop(subset=features)
    nodes = fit_forest(train, features, n_trees, sample_size, seed).cache()
    means = impute_means(train, features)
    offset = fit_offset(score_samples(train, nodes, features, sample_size), contamination)
    scored = detect(df, nodes, offset, features, means, sample_size)
    return scored, nodes, means, offset
