"""Silver-layer cleaning: dedup, densify, IQR fences, flags, forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions.quantiles import exact_quantiles
from loadcast.plans.halo import series_window
from loadcast.schemas import KEY, SILVER_COLUMNS


def dedup_latest(df: DataFrame, key: Sequence[str] = tuple(KEY),
                 order: Sequence[Column] | None = None, method: str = "aggregate") -> DataFrame:
    """Keep the latest row per key (latest ``ingested_at``; ties broken by the
    remaining ``order`` columns, then by the other columns, so one answer).

    ``method='aggregate'`` is a ``max_by`` aggregate: map-side partial
    aggregation reduces a hot key to one row per task before the shuffle.
    ``method='window'`` is the row_number form (Catalyst adds a window group
    limit).
    """
    key = list(key)
    if order is None:
        order = [F.col("ingested_at")]
    rest = [c for c in df.columns if c not in key]
    if method == "window":
        w = Window.partitionBy(*key).orderBy(*[o.desc() for o in order],
                                             *[F.col(c).desc_nulls_last() for c in rest])
        return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                    *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, "_best.*").select(*df.columns)


def densify(df: DataFrame, keys: Sequence[str] = ("country", "kind"), ts: str = "timestamp_utc",
            step: str = "1 hour", bounds: str = "global") -> DataFrame:
    """Insert missing steps so every series has one row per step.

    ``bounds='global'``: every series spans the overall [min, max] (two scalar
    subqueries, no join).  ``bounds='zone'``: each series its own [min, max].
    The grid is generated per series with ``explode(sequence)`` and left-joined
    back on (keys, ts).  Grid size is bounded by the time span (not by the
    input rows): one row per step and series.
    """
    keys = list(keys)
    interval = F.expr(f"INTERVAL {step}")
    if bounds == "global":
        # one scalar subquery for both bounds
        b = df.select(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi"))).scalar()
        zones = df.select(*keys).distinct().withColumn("_b", b)
        grid = zones.select(*keys, F.explode(F.sequence("_b.lo", "_b.hi", interval)).alias(ts))
    else:
        b = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
        grid = b.select(*keys, F.explode(F.sequence("_lo", "_hi", interval)).alias(ts))
    out = grid.join(df, [*keys, ts], "left")
    return out.select(*df.columns)


def iqr_fences(df: DataFrame, value: str = "load_mw", scope: str = "zone", k: float = 3.0,
               method: str = "exact", accuracy: int = 1000, by: Sequence[str] = ("country",)) -> DataFrame:
    """q1, q3, iqr and the ±k·IQR fences, per zone or over everything.

    ``method='approx'`` is ``percentile_approx`` (bounded sketch, relative
    error 1/accuracy); ``'exact'`` counts in ranges (linear interpolation; no
    group is gathered in one buffer).
    """
    keys = list(by) if scope == "zone" else []
    if method == "approx":
        agg = df.groupBy(*keys).agg(F.percentile_approx(value, [0.25, 0.75], accuracy).alias("_q"))
    else:
        agg = exact_quantiles(df, value, [0.25, 0.75], keys).withColumnRenamed("q", "_q")
    return agg.select(
        *keys,
        F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"),
        (F.col("_q")[1] - F.col("_q")[0]).alias("iqr"),
        (F.col("_q")[0] - F.lit(k) * (F.col("_q")[1] - F.col("_q")[0])).alias("lower"),
        (F.col("_q")[1] + F.lit(k) * (F.col("_q")[1] - F.col("_q")[0])).alias("upper"),
    )


def attach_fences(df: DataFrame, fences: DataFrame, scope: str = "zone",
                  by: Sequence[str] = ("country",)) -> DataFrame:
    """Put lower/upper next to every row.

    Global scope: two scalar subqueries (one row, no join).  Zone scope: a
    left join on the zone; the fence table has one row per zone and AQE
    turns it into a broadcast join once its measured size is under the
    broadcast threshold (else it stays a shuffle join).
    """
    if scope == "global":
        return df.withColumns({"lower": fences.select("lower").scalar(),
                               "upper": fences.select("upper").scalar()})
    return df.join(fences.select(*by, "lower", "upper"), list(by), "left")


def outlier_flag(value: str = "load_mw") -> Column:
    """NULL when the value (or a fence) is NULL."""
    return (F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper"))


def quality_flag(value: str = "load_mw", outlier: str = "is_outlier") -> Column:
    return (F.when(F.col(value).isNull(), F.lit("missing"))
            .when(F.col(outlier), F.lit("outlier"))
            .otherwise(F.lit("ok")))


def ffill(value: str = "load_mw", rows: int = 3):
    """Column factory: value, else the last non-null of the ``rows`` previous rows."""
    def make(w):
        return F.coalesce(F.col(value), F.last(value, ignorenulls=True).over(w.rowsBetween(-rows, 0)))
    return make


def flag_and_fill(df: DataFrame, value: str = "load_mw", scope: str = "zone", method: str = "exact",
                  k: float = 3.0, ffill_rows: int = 3, bucket_steps: int | None = None,
                  dense: bool = False) -> DataFrame:
    """Fences -> is_outlier -> quality_flag -> load_mw_clean (bounded ffill)."""
    fences = iqr_fences(df, value, scope=scope, k=k, method=method)
    flagged = (attach_fences(df, fences, scope)
               .withColumn("is_outlier", outlier_flag(value))
               .withColumn("quality_flag", quality_flag(value))
               .drop("lower", "upper"))
    return series_window(flagged, lambda w: {"load_mw_clean": ffill(value, ffill_rows)(w)},
                         lookback=ffill_rows, bucket_steps=bucket_steps, dense=dense)


def silver_projection(df: DataFrame) -> DataFrame:
    return df.select(*SILVER_COLUMNS)


def quality_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("country", "quality_flag").agg(F.count(F.lit(1)).alias("n"))
