"""Exact quantiles in two passes: a bounded sketch, then a count.

``percentile`` gathers one value -> count map per group, which for measured
values is the whole group in one buffer.  Here a mergeable KLL sketch of each
group brackets every rank asked for between two values, some multiples of the
sketch's rank error apart.  The second pass counts what lies below a bracket
(one number a task) and keeps the values inside (about one percent of the
group), which are counted, sorted and read at the exact rank.  A bracket that
missed its rank would raise; the margin makes that a matter of ten standard
deviations.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH = 4096   # size parameter of the sketches
MARGIN = 4.0    # brackets reach so many times the sketch's rank error (at 99 %)


def rank_error(k: int = SKETCH) -> float:
    """Normalised rank error of a KLL sketch with 99 % confidence (published fit)."""
    return 2.296 / k ** 0.9021


def sketch_quantile(sketch: Column, n: Column, p: float) -> Column:
    """Approximate quantile of a sketch of ``n`` values; null for none."""
    return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    sketch: int = SKETCH) -> DataFrame:
    """``(by..., q array<double>)``: linearly interpolated quantiles of the
    values that are neither null nor NaN, as ``percentile`` gives them; null for
    a group without any."""
    by = list(by)
    v = F.col(value).cast("double")
    rows = df.select(*by, F.when(~F.isnan(v), v).alias("_v"))
    own = rows.groupBy(*by).agg(F.count("_v").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"),
                                F.kll_sketch_agg_double("_v", F.lit(sketch)).alias("_s"))
    n, margin = F.col("_n"), MARGIN * rank_error(sketch)
    few = n < math.ceil(8 / margin)  # there, one rank more or less weighs more than the margin: keep all
    cuts, ranks = [], []
    for i, p in enumerate(probs):
        low = F.floor((n - 1) * F.lit(p))
        ranks.append((low, F.least(low + 1, n - 1)))
        a, z = p - margin, p + margin
        cuts += [F.col("_least") if a <= 0 else F.when(few, F.col("_least")).otherwise(sketch_quantile(F.col("_s"), n, a)),
                 F.col("_most") if z >= 1 else F.when(few, F.col("_most")).otherwise(sketch_quantile(F.col("_s"), n, z))]
    cuts = [c.alias(f"_{'az'[k % 2]}{k // 2}") for k, c in enumerate(cuts)]
    groups = own.select(*by, "_n", *cuts)
    some = rows.filter("_v is not null")
    if by:
        placed = some.join(groups, by)
    else:
        placed = some.withColumn("_g", groups.select(F.struct("*")).scalar()).select("_v", "_g.*")
    seen = F.array_compact(F.array(*[
        F.when(F.col("_v") < F.col(f"_a{i}"), F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("x")))
        .when(F.col("_v") <= F.col(f"_z{i}"), F.struct(F.lit(i).alias("i"), F.col("_v").alias("x"))) for i in range(len(probs))]))
    counts = (placed.select(*by, "_n", F.explode(seen).alias("e")).groupBy(*by, "_n", F.col("e.i").alias("_i"), F.col("e.x").alias("_x"))
              .agg(F.count(F.lit(1)).alias("_c")))
    upto = F.sum("_c").over(Window.partitionBy(*by, "_i").orderBy(F.asc_nulls_first("_x")).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto)
    out = []
    for i, (p, (low, high)) in enumerate(zip(probs, ranks, strict=True)):
        mine = F.col("_i") == i
        out += [F.min(F.when(mine & (F.col("_upto") > low), F.struct(F.col("_upto"), F.col("_x")))).alias(f"_l{i}"),
                F.min(F.when(mine & (F.col("_upto") > high), F.struct(F.col("_upto"), F.col("_x")))).alias(f"_h{i}")]
    picked = ranked.groupBy(*by, "_n").agg(*out)
    values = []
    for i, (p, (low, _)) in enumerate(zip(probs, ranks, strict=True)):
        a, b = F.col(f"_l{i}")["_x"], F.col(f"_h{i}")["_x"]
        missed = F.raise_error(F.lit(f"quantile {p}: the sketch's bracket missed its rank")).cast("double")
        values.append(F.when(a.isNull() | b.isNull(), missed).otherwise(a + (b - a) * ((n - 1) * F.lit(p) - low)))
    found = picked.select(*by, F.array(*values).alias("q"))
    if by:
        return own.select(*by).join(found, by, "left")
    return own.select(F.lit(1).alias("_one")).join(found.withColumn("_one", F.lit(1)), "_one", "left").select("q")
