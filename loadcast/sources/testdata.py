"""Driver tables and the fixture views that stand in for load series.

The test tables are TPC-H-like; the hourly load model is derived from them:
``events`` (event_type = zone) gives hourly series, ``orders``
(o_orderpriority = zone) gives daily long-horizon series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions.timecols import day_floor, hour_floor
from loadcast.operators.quality import densify
from loadcast.session import ensure_utc

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Zone -> holiday calendar for the fixture zones (event types).
FIXTURE_ZONE_MAP = {"click": "US", "error": "ES", "purchase": "US", "signup": "ES", "view": "ES"}
# Fixture zones, used as the "fuel" columns of generation_wide.
FIXTURE_ZONES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as bronze rows: many rows per (hour, zone) key."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        hour_floor("ts").alias("timestamp_utc"),
        F.col("event_type").alias("country"),
        F.lit("actual").alias("kind"),
        F.col("value").alias("load_mw"),
        F.col("ts").alias("ingested_at"),
        F.col("event_id"),
    )


def load_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly load per zone: sum of values, ingested_at = last event time."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("country"), hour_floor("ts").alias("timestamp_utc"))
            .agg(F.sum("value").alias("load_mw"), F.max("ts").alias("ingested_at"))
            .select("timestamp_utc", "country", F.lit("actual").alias("kind"), "load_mw", "ingested_at"))


def load_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``load_hourly`` densified to every hour of the global span, per zone."""
    return densify(load_hourly(spark, sf_dir), bounds="global")


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series per order priority, densified by day."""
    o = table(spark, sf_dir, "orders")
    daily = (o.groupBy(F.col("o_orderpriority").alias("country"), day_floor("o_orderdate").alias("timestamp_utc"))
             .agg(F.sum("o_totalprice").alias("load_mw"), F.max("o_orderdate").alias("ingested_at"))
             .select("timestamp_utc", "country", F.lit("actual").alias("kind"), "load_mw", "ingested_at"))
    return densify(daily, step="1 day", bounds="global")


def generation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table: one column per fixture zone (as fuel), nulls where absent."""
    hourly = load_hourly(spark, sf_dir)
    wide = hourly.groupBy("timestamp_utc").pivot("country", FIXTURE_ZONES).agg(F.first("load_mw"))
    return wide.select("timestamp_utc", F.lit("ALL").alias("country"), *FIXTURE_ZONES)
