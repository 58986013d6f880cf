"""Splits, forecast metrics, baselines and champion selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions import stats
from loadcast.functions.timecols import date_offset


def cutoff(df: DataFrame, test_days: int, ts: str = "timestamp_utc") -> Column:
    """max(ts) - test_days, as a scalar subquery (no join)."""
    return df.select(date_offset(F.max(ts), days=-test_days)).scalar()


def time_split(df: DataFrame, test_days: int = 30, ts: str = "timestamp_utc", per_zone: bool = False) -> DataFrame:
    """Label rows train (ts <= max - test_days) or test (ts > cutoff).
    ``per_zone``: each zone's own max (a grouped max joined back; the
    one-row-per-zone table is broadcast by AQE once measured)."""
    if per_zone:
        mx = df.groupBy("country").agg(F.max(ts).alias("_zmax"))
        out = df.join(mx, "country", "left")
        c = date_offset("_zmax", days=-test_days)
        return out.withColumn("split", F.when(F.col(ts) <= c, F.lit("train")).otherwise(F.lit("test"))).drop("_zmax")
    c = cutoff(df, test_days, ts)
    return df.withColumn("split", F.when(F.col(ts) <= c, F.lit("train")).otherwise(F.lit("test")))


def tail_fraction_split(df: DataFrame, frac: float = 0.9, ts: str = "timestamp_utc",
                        by: Sequence[str] = ("country",), bucket: str = "day") -> DataFrame:
    """First floor(frac * n) rows of each series (in time order) are train,
    the rest validation.

    The global rank of a row inside its series is computed in two levels so
    no task holds a whole series: rows per (series, day) are counted and
    prefix-summed over days (a table of series x days), and the rank inside a
    day comes from a window over that day only.  Exact for any spacing."""
    by = list(by)
    b = F.date_trunc(bucket, ts).cast("timestamp_ntz")
    keyed = df.withColumn("_bk", b)
    counts = keyed.groupBy(*by, "_bk").agg(F.count(F.lit(1)).alias("_c"))
    wz = Window.partitionBy(*by)
    before = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bk", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
                            F.sum("_c").over(wz).alias("_n"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy(*by, "_bk").orderBy(ts))
    out = keyed.join(offsets, [*by, "_bk"], "left").withColumn("_rank", rank)
    return (out.withColumn("split", F.when(F.col("_rank") <= F.floor(F.lit(frac) * F.col("_n")), F.lit("train"))
                           .otherwise(F.lit("validation")))
            .drop("_bk", "_before", "_n", "_rank"))


def forecast_metrics(df: DataFrame, y: str = "y", p: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """MAPE (|e| / max(|y|, eps)), RMSE, MAE; one row per group."""
    return df.groupBy(*by).agg(stats.mape(y, p).alias("mape"), stats.rmse(y, p).alias("rmse"),
                               stats.mae(y, p).alias("mae"), F.count(F.lit(1)).alias("n"))


def mask_valid(df: DataFrame, p: str = "prediction") -> DataFrame:
    """Rows with a usable prediction (not NULL / NaN)."""
    return df.filter(F.col(p).isNotNull() & ~F.isnan(p))


def mean_baseline(train: DataFrame, test: DataFrame, y: str = "y") -> DataFrame:
    """Predict the training mean everywhere.  The mean is fetched as a value
    (a one-row aggregate): the training frame already holds a cutoff
    subquery, and nesting subqueries ties up the subquery thread pool."""
    m = train.select(F.avg(y)).first()[0]
    return test.withColumn("prediction", F.lit(m).cast("double"))


def champion_pick(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """Lowest MAPE; ties go to the earlier declared candidate."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    best = F.min_by(F.col("model"), F.struct(F.col("mape"), rank))
    return metrics.agg(best.alias("model"), F.min("mape").alias("mape"))


def run_summary(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    champ = champion_pick(metrics, order).first()["model"]  # one row per candidate model
    return metrics.withColumn("is_champion", F.col("model") == F.lit(champ))


def min_rows_guard(counts: DataFrame, n_col: str = "n", minimum: int = 100) -> DataFrame:
    return counts.withColumn("status", F.when(F.col(n_col) < minimum, F.lit("insufficient")).otherwise(F.lit("ok")))
