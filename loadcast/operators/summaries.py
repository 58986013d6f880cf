"""Dashboard content as tables: KPIs, profile, recent window, zone lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions.calendar import US_SOURCE_ZONES
from loadcast.functions.quantiles import exact_quantiles


def kpi_summary(df: DataFrame, value: str = "load_mw_clean", ts: str = "timestamp_utc") -> DataFrame:
    """Per zone: records, mean and peak load, first and last date."""
    return df.groupBy("country").agg(
        F.count(F.lit(1)).alias("records"),
        F.avg(value).alias("avg_load"),
        F.max(value).alias("peak_load"),
        F.date_format(F.min(ts), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max(ts), "yyyy-MM-dd").alias("last_date"),
    )


def hourly_profile(df: DataFrame, value: str = "load_mw_clean", exact: bool = True) -> DataFrame:
    """Median and inter-quartile band of load per (zone, hour of day)."""
    probs = [0.5, 0.25, 0.75]
    q = (exact_quantiles(df, value, probs, ["country", "hour"]).withColumnRenamed("q", "_q") if exact
         else df.groupBy("country", "hour").agg(F.percentile_approx(value, probs, 10000).alias("_q")))
    return (q.select("country", "hour", F.col("_q")[0].alias("median"), F.col("_q")[1].alias("q25"),
                    F.col("_q")[2].alias("q75")))


def last_n(df: DataFrame, n: int = 720, ts: str = "timestamp_utc", by: Sequence[str] = ("country",)) -> DataFrame:
    """The n most recent rows of each zone (top-k per group: Catalyst adds a
    partial window group limit before the shuffle, so at most n rows per zone
    and task move)."""
    w = Window.partitionBy(*by).orderBy(F.col(ts).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, n: int = 10, ts: str = "timestamp_utc", tie: Sequence[str] = ("country",)) -> DataFrame:
    """n most recent rows overall (TakeOrderedAndProject)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).asc() for c in tie]).limit(n)


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ("timestamp_utc", "country")) -> DataFrame:
    return df.orderBy(*order).limit(n)


def zone_list(df: DataFrame) -> DataFrame:
    return df.select("country").distinct().orderBy("country")


def zone_count(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("country").alias("n_zones"))


def region_filter(df: DataFrame, zone: str) -> DataFrame:
    """One zone; on a table partitioned by country this prunes partitions."""
    return df.filter(F.col("country") == F.lit(zone))


def series_extent(df: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    return df.groupBy("country").agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_ts"),
                                     F.max(ts).alias("max_ts"))


def max_timestamp(df: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    return df.agg(F.max(ts).alias("max_ts"))


def source_label(zone: Column | str = "country", us_zones: Sequence[str] = tuple(US_SOURCE_ZONES)) -> Column:
    z = F.col(zone) if isinstance(zone, str) else zone
    # The two data-source captions.
    return F.when(z.isin(list(us_zones)), F.lit("EIA Open Data")).otherwise(F.lit("ENTSO-E Transparency Platform"))
