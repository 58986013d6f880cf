"""Feature attribution as Spark jobs.

* ``sampled_shapley``: model-agnostic permutation sampling (Strumbelj &
  Kononenko 2014).  For each (row, permutation) a background row is drawn
  and the F+1 coalition rows along the permutation are scored with one
  ``transform``; consecutive differences are the marginal contributions,
  averaged per (row, feature).  Work: rows x permutations x (F + 1) model
  evaluations, distributed like any other DataFrame.
* ``tree_attribution``: exact Shapley values of a tree ensemble, absent features
  taken as the training rows reached a node (path-dependent).  A leaf's value
  splits over the features of its path in closed form: with ``o`` (does the row
  follow all splits on the feature) and ``z`` (share of training rows that do),
  the coalitions of the other features are the coefficients of a small
  polynomial.  It is evaluated once per pattern of ``o`` that occurs, not per
  row.  Values of a row add up to its prediction less the baseline.
* ``linear_attribution``: exact values of a linear model, w * (x - mean).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_BACKGROUND = 10_000


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Deterministic sample of n rows: the n smallest seeded hashes."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")


def sampled_shapley(model, rows: DataFrame, background: DataFrame, features: Sequence[str],
                    key: Sequence[str], permutations: int = 16, seed: int = 7,
                    prediction: str = "prediction") -> DataFrame:
    """(key..., feature, phi) by permutation sampling over ``model.transform``.

    ``background`` is broadcast and numbered in one task: over
    ``MAX_BACKGROUND`` rows it is refused (pass a ``sample_n``).
    """
    features = list(features)
    if background.limit(MAX_BACKGROUND + 1).count() > MAX_BACKGROUND:
        raise ValueError(f"background has over {MAX_BACKGROUND} rows; draw a sample_n of it")
    nf = len(features)
    bg = background.select(*[F.col(f).alias(f"_b_{f}") for f in features])
    bg = bg.withColumn("_bid", F.row_number().over(Window.orderBy(*[f"_b_{f}" for f in features])) - 1)
    n_bg = bg.select(F.count(F.lit(1))).scalar()
    keyh = [F.col(k) for k in key]
    perm = F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("_perm")
    r = rows.select(*key, *features, perm)
    r = r.withColumn("_bid", F.pmod(F.xxhash64(*keyh, F.col("_perm"), F.lit(seed)), n_bg))
    # random order of the features for this (row, permutation): position of each feature
    order = F.sort_array(F.array(*[F.struct(F.xxhash64(*keyh, F.col("_perm"), F.lit(i), F.lit(seed)).alias("h"),
                                             F.lit(i).alias("i")) for i in range(nf)]))
    r = r.withColumn("_order", F.transform(order, lambda s: s["i"]))
    r = r.join(F.broadcast(bg), "_bid")
    steps = r.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(nf))))
    # coalition j: the first j features of the order come from the row, the rest from the background
    pos = {f: F.array_position(F.col("_order"), F.lit(i)) - 1 for i, f in enumerate(features)}
    steps = steps.withColumns({f: F.when(pos[f] < F.col("_j"), F.col(f)).otherwise(F.col(f"_b_{f}"))
                               for f in features})
    scored = model.transform(steps.select(*key, "_perm", "_j", "_order", *features))
    w = Window.partitionBy(*key, "_perm").orderBy("_j")
    diffs = (scored.select(*key, "_perm", "_j", "_order", prediction)
             .withColumn("_d", F.col(prediction) - F.lag(prediction).over(w))
             .filter(F.col("_j") >= 1)
             .withColumn("_fi", F.element_at("_order", F.col("_j"))))
    names = F.array(*[F.lit(f) for f in features])
    return (diffs.groupBy(*key, F.element_at(names, F.col("_fi") + 1).alias("feature"))
            .agg(F.avg("_d").alias("phi")))


def mean_abs_attribution(attr: DataFrame) -> DataFrame:
    return attr.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))


class Leaves:
    """Leaves of an ensemble: value and, per feature of the path, the interval
    (low, high] that leads there and the share of training rows that follow."""

    def __init__(self, trees: Sequence[Mapping[str, list]], weights: Sequence[float]) -> None:
        self.leaves: list[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.baseline = 0.0
        for t, weight in zip(trees, weights, strict=True):
            todo = [(0, {}, 1.0)]
            while todo:
                k, path, reach = todo.pop()
                if t["left"][k] < 0:
                    value = weight * t["value"][k]
                    self.baseline += value * reach
                    names = sorted(path)
                    own = [path[f] for f in names]
                    if names:
                        self.leaves.append((value, np.array(names), *(np.array([x[i] for x in own], float) for i in range(3))))
                    continue
                f, cut = t["feature"][k], t["threshold"][k]
                for child, left in ((t["left"][k], True), (t["right"][k], False)):
                    share = t["count"][child] / t["count"][k]
                    low, high, z = path.get(f, (-math.inf, math.inf, 1.0))
                    todo.append((child, path | {f: (low, min(high, cut), z * share) if left else (max(low, cut), high, z * share)}, reach * share))

    def values(self, x: np.ndarray) -> np.ndarray:
        """Shapley values, rows by features."""
        phi = np.zeros(x.shape)
        for value, names, low, high, z in self.leaves:
            own = x[:, names]
            follows = (own > low) & (own <= high)
            m = len(names)
            bits = follows @ (1 << np.arange(m, dtype=np.int64))
            codes, row = np.unique(bits, return_inverse=True)
            o = (codes[:, None] >> np.arange(m) & 1).astype(float)
            part = np.empty((len(codes), m))
            for i in range(m):
                poly = np.zeros((len(codes), m))  # coefficient k: coalitions of k others
                poly[:, 0] = 1.0
                for n, j in enumerate([j for j in range(m) if j != i], 1):
                    poly[:, 1:n + 1] = poly[:, 1:n + 1] * z[j] + poly[:, :n] * o[:, [j]]
                    poly[:, 0] *= z[j]
                shares = np.array([math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)])
                part[:, i] = value * (o[:, i] - z[i]) * (poly @ shares)
            phi[:, names] += part[row]
        return phi


def tree_tables(model) -> tuple[list[dict[str, list]], list[float]]:
    """Node arrays of a fitted tree regressor or ensemble (continuous splits);
    bounded by trees times nodes, like the model that the driver holds."""
    trees = list(model.trees) if hasattr(model, "trees") else [model]
    weights = [float(w) for w in model.treeWeights] if hasattr(model, "treeWeights") else [1.0]
    out = []
    for t in trees:
        nodes: dict[str, list] = {n: [] for n in ("left", "right", "feature", "threshold", "value", "count")}
        todo = [(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode"), -1, "left")]
        while todo:
            node, parent, side = todo.pop()
            k = len(nodes["left"])
            if parent >= 0:
                nodes[side][parent] = k
            inner = node.subtreeDepth() > 0
            for n, v in (("left", -1), ("right", -1), ("feature", node.split().featureIndex() if inner else -1),
                         ("threshold", node.split().threshold() if inner else 0.0), ("value", node.prediction()), ("count", float(node.impurityStats().count()))):
                nodes[n].append(v)
            if inner:
                todo += [(node.rightChild(), k, "right"), (node.leftChild(), k, "left")]
        out.append(nodes)
    return out, weights


def tree_attribution(model, rows: DataFrame, features: Sequence[str], key: Sequence[str]) -> tuple[DataFrame, float]:
    """``(key..., feature, phi)`` for every row without a missing feature, and
    the baseline (the mean prediction over the training rows' shares)."""
    features, key = list(features), list(key)
    leaves = Leaves(*tree_tables(model))
    held = rows.sparkSession.sparkContext.broadcast((leaves.leaves, leaves.baseline))

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Leaves([], [])
        own.leaves, own.baseline = held.value
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy(zero_copy_only=False) for f in features]) if len(b) else np.zeros((0, len(features)))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in key), pa.array(list(own.values(x)), pa.list_(pa.float64()))], [*key, "phis"])

    ready = rows.select(*key, *[F.col(f).cast("double").alias(f) for f in features]).na.drop(subset=features)
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ready.select(*key).schema.fields)
    phis = ready.mapInArrow(explain, f"{out}, phis array<double>")
    named = F.arrays_zip(F.array(*[F.lit(f) for f in features]).alias("feature"), F.col("phis").alias("phi"))
    return phis.select(*key, F.explode(named).alias("a")).select(*key, F.col("a.feature").alias("feature"), F.col("a.phi").alias("phi")), leaves.baseline


def linear_attribution(rows: DataFrame, weights: Mapping[str, float], means: Mapping[str, float], key: Sequence[str]) -> DataFrame:
    """``(key..., feature, phi)`` of a linear model; a missing value has none."""
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), (F.lit(float(w)) * (F.col(f) - F.lit(float(means[f])))).alias("phi")) for f, w in weights.items()])
    return rows.select(*key, F.explode(parts).alias("a")).select(*key, "a.feature", "a.phi")
