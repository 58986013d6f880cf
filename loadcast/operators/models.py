"""One stored form for every model, and scoring by alias.

A model is a folder: ``meta`` (one JSON row: family, the input columns with
their types, small parameters), and the family's own data beside it (a boosting
pipeline, coefficients per zone, the node table of a forest).  The ledger names
the folder; an alias is the newest row that carries it.  Before anything is
scored the input is compared with the stored signature.

Families: ``gbt``, ``seasonal``, ``sequence`` (reads the series it continues),
``seasonal_naive``, ``mean`` give ``prediction``; ``isolation_forest`` gives
``anomaly_score`` and ``is_anomaly``.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.operators import anomaly as an
from loadcast.operators import forecast as fc
from loadcast.schemas import ANOMALY_FEATURES, FEATURE_COLS

_STATS = ("mean", "std")


class SignatureMismatch(ValueError):
    """The input lacks columns of the model, or has others under their names."""


def _inputs(family: str, meta: Mapping) -> list[str]:
    return {"gbt": meta.get("features", []), "seasonal": ["timestamp_utc", "country"], "sequence": ["timestamp_utc", "country", "kind"],
            "seasonal_naive": ["load_mw_clean_lag_24"], "mean": [], "isolation_forest": meta.get("features", [])}[family]


def save_model(spark: SparkSession, family: str, fitted, path: str, sample: DataFrame) -> str:
    """Store a fitted model; ``sample`` has the input's columns and types.
    Returns the signature.

    ``fitted``: gbt a pipeline; seasonal (coefficients, settings); sequence what
    ``fit_sequence`` returns; mean a number; isolation_forest (nodes, offset as a
    number, means as a one-row table, sample size)."""
    meta: dict = {}
    if family == "gbt":
        fitted.write().overwrite().save(f"{path}/pipeline")
        meta["features"] = [c for s in fitted.stages if hasattr(s, "getInputCols") for c in s.getInputCols()]
    elif family == "seasonal":
        coefs, settings = fitted
        coefs.write.mode("overwrite").parquet(f"{path}/coefs")
        b = spark.range(1).select(settings["origin"].cast("string").alias("o"), settings["span"].alias("s")).first()
        meta |= {"origin": b["o"], "span": b["s"], "names": settings["names"], "design": settings["design"]}
    elif family == "sequence":
        st = fitted["stats"].first()
        meta |= {k: fitted[k] for k in ("intercept", "coef", "penalty", "length", "target", "bucket_steps")}
        meta |= {k: st[f"{fitted['target']}__{k}"] for k in _STATS}
    elif family == "mean":
        meta["value"] = fitted
    elif family == "isolation_forest":
        nodes, offset, means, size = fitted
        nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta |= {"offset": offset, "means": means.first().asDict(), "sample_size": size, "features": means.columns}
    elif family != "seasonal_naive":
        raise ValueError(f"unknown family: {family}")
    names = _inputs(family, meta)
    signature = sample.select(*names).schema.json()
    spark.createDataFrame([(family, signature, json.dumps(meta))], "family string, signature string, meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return signature


class Model:
    """A stored model, loaded."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        r = spark.read.schema("family string, signature string, meta string").json(f"{path}/meta").first()
        self.spark, self.path, self.family, self.signature, self.meta = spark, path, r["family"], r["signature"], json.loads(r["meta"])

    def check(self, df: DataFrame) -> None:
        """Refuse an input that does not match the signature."""
        have = {f.name: f.dataType for f in df.schema.fields}
        wrong = []
        for f in T.StructType.fromJson(json.loads(self.signature)).fields:
            if f.name not in have:
                wrong.append(f"{f.name} is missing")
            elif have[f.name] != f.dataType and not _widens(have[f.name], f.dataType):
                wrong.append(f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
        if wrong:
            raise SignatureMismatch(f"{self.family}: {'; '.join(wrong)}")

    def score(self, df: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """Every row of ``df`` with its prediction (or score); ``history`` are the
        rows that a sequence continues (``df`` itself where it has them)."""
        self.check(df)
        m = self.meta
        if self.family == "gbt":
            return fc.predict(PipelineModel.load(f"{self.path}/pipeline"), df)
        if self.family == "seasonal":
            settings = {"origin": F.lit(dt.datetime.fromisoformat(m["origin"])).cast("timestamp_ntz"), "span": F.lit(float(m["span"])), "names": m["names"], "design": m["design"]}
            return fc.predict_seasonal(df, self.spark.read.parquet(f"{self.path}/coefs"), settings)
        if self.family == "sequence":
            target = m["target"]
            stats = self.spark.createDataFrame([(m["mean"], m["std"])], f"{target}__mean double, {target}__std double")
            fitted = {k: m[k] for k in ("intercept", "coef", "length", "target", "bucket_steps")} | {"stats": stats}
            keys = ["timestamp_utc", "country", "kind"]
            if history is None:
                if target not in df.columns:
                    raise ValueError("a sequence model needs the rows of the series: pass history")
                return fc.predict_sequence(fitted, df)
            return df.join(fc.predict_sequence(fitted, history.select(*keys, target)).select(*keys, "prediction"), keys, "left")
        if self.family == "seasonal_naive":
            return df.withColumn("prediction", F.col("load_mw_clean_lag_24"))
        if self.family == "mean":
            return df.withColumn("prediction", F.lit(m["value"]).cast("double"))
        means = self.spark.createDataFrame([tuple(float(m["means"][c]) for c in m["features"])], ", ".join(f"{c} double" for c in m["features"]))
        return an.detect(df, self.spark.read.parquet(f"{self.path}/nodes"), float(m["offset"]), m["features"], means, m["sample_size"])


def _widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether a value keeps its meaning in the wanted type."""
    order = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if have in order and want in order:
        return True
    return isinstance(want, T.DoubleType) and (have in order or isinstance(have, T.FloatType))


def resolve(spark: SparkSession, ledger_path: str, alias: str) -> str:
    """Folder of the newest model that carries the alias."""
    rows = spark.read.parquet(ledger_path).filter((F.col("alias") == alias) & F.col("model_path").isNotNull())
    newest = rows.agg(F.max_by("model_path", F.struct("logged_at", "run_id"))).first()[0]
    if newest is None:
        raise LookupError(f"no model carries the alias {alias!r}")
    return newest


def score_by_alias(spark: SparkSession, ledger_path: str, alias: str, df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    return Model(spark, resolve(spark, ledger_path, alias)).score(df, history)


def sample_of(gold: DataFrame, features: Sequence[str] = (*FEATURE_COLS, *ANOMALY_FEATURES)) -> DataFrame:
    """The columns and types that stored models expect of scoring rows."""
    return gold.select("timestamp_utc", "country", "kind", *dict.fromkeys(features))
