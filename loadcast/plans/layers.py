"""Layer builders over the fixture views (silver and gold of the test data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadcast.operators.features import build_gold
from loadcast.operators.quality import flag_and_fill, silver_projection
from loadcast.session import work_dir
from loadcast.sources import testdata as td

# Zone -> calendar for the daily order series.
ORDERS_ZONE_MAP = {"1-URGENT": "US", "2-HIGH": "ES", "3-MEDIUM": "US", "4-NOT SPECIFIED": "ES", "5-LOW": "US"}


def silver_grid(spark: SparkSession, sf_dir: str, method: str = "exact", bucket_steps: int | None = 2016) -> DataFrame:
    """load_grid (written once: fences, flags and fill all read it) -> per-zone
    fences, flags, 3-hour forward fill."""
    grid = materialize(td.load_grid(spark, sf_dir), "grid")
    return silver_projection(flag_and_fill(grid, method=method, bucket_steps=bucket_steps, dense=True))


def gold_grid(spark: SparkSession, sf_dir: str, drop: bool = True, holidays: str = "movable",
              bucket_steps: int | None = 2016) -> DataFrame:
    return build_gold(silver_grid(spark, sf_dir), zone_map=td.FIXTURE_ZONE_MAP, holidays=holidays,
                      drop=drop, bucket_steps=bucket_steps, dense=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint root and read it
    back: one job, lineage cut (a lost executor re-reads files instead of
    recomputing the plan), and later scans get column pruning."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def gold_table(spark: SparkSession, sf_dir: str, drop: bool = True) -> DataFrame:
    """Gold written once: model and drift jobs read it many times (splits,
    scalar bounds, several fits)."""
    return materialize(gold_grid(spark, sf_dir, drop=drop), "gold")

