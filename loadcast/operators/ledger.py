"""Model ledger (append-only Parquet table) and input signatures."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("family", T.StringType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("alias", T.StringType(), True),
    T.StructField("model_path", T.StringType(), True),
    T.StructField("signature", T.StringType(), True),
    T.StructField("logged_at", T.TimestampNTZType(), True),
])


def ledger_rows(spark: SparkSession, runs: list[Mapping]) -> DataFrame:
    """One row per run; ``runs`` holds small per-model records (a handful)."""
    rows = [(r.get("run_id") or uuid.uuid4().hex, r["family"], {k: str(v) for k, v in r.get("params", {}).items()},
             {k: float(v) for k, v in r.get("metrics", {}).items() if v is not None}, r.get("alias"),
             r.get("model_path"), r.get("signature"), None) for r in runs]
    df = spark.createDataFrame(rows, LEDGER_SCHEMA)
    return df.withColumn("logged_at", F.localtimestamp())


def append_ledger(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def signature(df: DataFrame, columns: list[str]) -> str:
    return df.select(*columns).schema.json()


def signature_check(df: DataFrame, stored: str) -> DataFrame:
    """Per expected column: present?, expected and actual type, ok; and, over
    all rows, how many there are and how many hold a value of the expected
    type (one aggregate pass)."""
    expected = T.StructType.fromJson(json.loads(stored))
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    usable = [F.count(F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})") if f.name in actual else F.lit(None)).alias(f.name)
              for f in expected.fields]
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.struct(*usable).alias("u"))
    rows = F.array(*[F.struct(
        F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("expected"),
        F.lit(actual.get(f.name)).cast("string").alias("actual"), F.lit(f.name in actual).alias("present"),
        F.lit(actual.get(f.name) == f.dataType.simpleString()).alias("ok"), F.col("u")[f.name].alias("n_usable"))
        for f in expected.fields])
    return counts.select("n_rows", F.explode(rows).alias("r")).select("r.*", "n_rows")
