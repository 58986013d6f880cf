"""Fixed schemas and column lists of the layered tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the layer tables and their key.
KEY = ["timestamp_utc", "country", "kind"]

BRONZE_SCHEMA = T.StructType([
    T.StructField("timestamp_utc", T.TimestampNTZType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("load_mw", T.DoubleType(), True),
    T.StructField("kind", T.StringType(), False),
    T.StructField("ingested_at", T.TimestampNTZType(), False),
])

SILVER_COLUMNS = [
    "timestamp_utc", "country", "kind", "load_mw", "load_mw_clean",
    "is_outlier", "quality_flag", "ingested_at",
]

TARGET = "load_mw_clean"
DEFAULT_LAGS = (1, 24, 48, 168)
DEFAULT_ROLLS = (24, 168)

CALENDAR_INT_COLUMNS = [
    "hour", "day_of_week", "day_of_month", "month", "quarter", "year",
    "week_of_year", "is_weekend",
]
CYCLIC_COLUMNS = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]

# Model feature lists of the forecasting and anomaly matrices.
FEATURE_COLS = [
    "hour", "day_of_week", "day_of_month", "month", "quarter", "week_of_year",
    "is_weekend", "is_holiday_es",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "load_mw_clean_lag_1", "load_mw_clean_lag_24", "load_mw_clean_lag_48",
    "load_mw_clean_lag_168",
    "load_mw_clean_roll_mean_24", "load_mw_clean_roll_std_24",
    "load_mw_clean_roll_mean_168", "load_mw_clean_roll_std_168",
]
ANOMALY_FEATURES = [
    "load_mw_clean",
    "hour", "day_of_week", "is_weekend",
    "load_mw_clean_lag_24", "load_mw_clean_lag_168",
    "load_mw_clean_roll_mean_24", "load_mw_clean_roll_std_24",
]
DRIFT_FEATURES = list(ANOMALY_FEATURES)


def lag_name(target: str, k: int) -> str:
    return f"{target}_lag_{k}"


def roll_names(target: str, w: int) -> tuple[str, str]:
    return f"{target}_roll_mean_{w}", f"{target}_roll_std_{w}"
