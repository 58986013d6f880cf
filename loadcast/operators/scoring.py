"""Batch scoring: request validation, model scoring, counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_I, _D, _S = T.LongType(), T.DoubleType(), T.StringType()

# Request row fields and types of the two scoring endpoints.
FORECAST_REQUEST = T.StructType([T.StructField(n, t) for n, t in [
    ("timestamp_utc", _S), ("hour", _I), ("day_of_week", _I), ("day_of_month", _I), ("month", _I),
    ("quarter", _I), ("week_of_year", _I), ("is_weekend", _I), ("is_holiday_es", _I),
    ("hour_sin", _D), ("hour_cos", _D), ("dow_sin", _D), ("dow_cos", _D), ("month_sin", _D), ("month_cos", _D),
    ("load_mw_clean_lag_1", _D), ("load_mw_clean_lag_24", _D), ("load_mw_clean_lag_48", _D),
    ("load_mw_clean_lag_168", _D), ("load_mw_clean_roll_mean_24", _D), ("load_mw_clean_roll_std_24", _D),
    ("load_mw_clean_roll_mean_168", _D), ("load_mw_clean_roll_std_168", _D)]])
ANOMALY_REQUEST = T.StructType([T.StructField(n, t) for n, t in [
    ("timestamp_utc", _S), ("country", _S), ("load_mw_clean", _D), ("hour", _I), ("day_of_week", _I),
    ("is_weekend", _I), ("load_mw_clean_lag_24", _D), ("load_mw_clean_lag_168", _D),
    ("load_mw_clean_roll_mean_24", _D), ("load_mw_clean_roll_std_24", _D)]])

MAX_ROWS = 10_000


def as_request(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """Render rows the way a JSON request body carries them (all text)."""
    cols = [F.col(f.name).cast("string").alias(f.name) for f in schema.fields]
    return df.select(*extra, *cols)


def check_request(req: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed request rows + ``valid`` and ``reason`` per row.  Every valid row
    is scored, whatever the size of its batch.

    A field is invalid when it is missing, NULL, or does not convert
    (``try_cast`` NULL on a non-NULL input).
    """
    missing = [f.name for f in schema.fields if f.name not in req.columns]
    typed, problems = {}, []
    for f in schema.fields:
        if f.name in missing:
            typed[f.name] = F.lit(None).cast(f.dataType)
            problems.append(F.lit(f"missing:{f.name}"))
            continue
        raw = F.col(f.name)
        if isinstance(f.dataType, T.LongType):
            conv = F.expr(f"try_cast(`{f.name}` AS DOUBLE)")
            conv = F.when(conv == F.floor(conv), conv.cast("bigint"))
        else:
            conv = F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        typed[f.name] = conv
        problems.append(F.when(raw.isNull(), F.lit(f"null:{f.name}"))
                        .when(conv.isNull(), F.lit(f"type:{f.name}")))
    reasons = F.filter(F.array(*problems), lambda x: x.isNotNull())
    out = req.select(*[c for c in req.columns if c not in typed], *[v.alias(k) for k, v in typed.items()],
                     reasons.alias("_reasons"))
    return (out.withColumn("valid", F.size("_reasons") == 0)
            .withColumn("reason", F.array_join("_reasons", ",")).drop("_reasons"))


def batch_report(checked: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch: rows, valid and invalid ones, and whether the batch would fit
    one request body (``MAX_ROWS``).  A report only: nothing is rejected by it."""
    n_valid = F.sum(F.col("valid").cast("bigint"))
    return checked.groupBy(batch).agg(F.count(F.lit(1)).alias("n_rows"), n_valid.alias("n_valid"),
                                      (F.count(F.lit(1)) - n_valid).alias("n_invalid")).withColumn(
        "batch_status", F.when(F.col("n_rows").between(1, MAX_ROWS), F.lit("ok")).otherwise(F.lit("rejected")))


def score_counters(checked: DataFrame, endpoint: str) -> DataFrame:
    """Rows by (endpoint, status): scored / invalid_row."""
    status = F.when(F.col("valid"), F.lit("scored")).otherwise(F.lit("invalid_row"))
    return checked.groupBy(F.lit(endpoint).alias("endpoint"), status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"))
