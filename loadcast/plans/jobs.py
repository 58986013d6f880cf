"""Composed jobs: bronze -> silver -> gold -> train / drift / dashboard.

Each job reads its input layer from storage and writes its output layer, so
lineage is cut at every layer boundary (a lost executor recomputes from the
last written table, never from the raw landing zone).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadcast.operators import anomaly as an
from loadcast.operators import drift as dr
from loadcast.operators import ledger as lg
from loadcast.operators import models
from loadcast.operators import summaries as sm
from loadcast.operators import quality as qa
from loadcast.operators.training import ledger_records, train_forecasters
from loadcast.plans import incremental as inc
from loadcast.schemas import DRIFT_FEATURES
from loadcast.session import work_dir
from loadcast.sources import tables
from loadcast.sources.landed import source_dispatch


def _count(obs: Observation) -> int:
    return int(obs.get["rows"])


def job_bronze(spark: SparkSession, readers: dict[str, Callable[[], DataFrame]], source: str,
               bronze_path: str, ingested_at) -> DataFrame:
    """dispatch -> typed -> one row per key -> upsert -> observed count; the
    changed hours go to the change log, rows that lack a required value to a
    table of their own, counted too."""
    raw = source_dispatch(readers, source)
    typed = tables.bronze_typed(raw, ingested_at=ingested_at)
    path = f"{work_dir(spark, 'batch')}/t"
    qa.dedup_latest(typed, order=[F.col("ingested_at")]).write.parquet(path)
    batch = spark.read.parquet(path)
    obs, bad = Observation("bronze"), Observation("rejects")
    tables.upsert(spark, batch, bronze_path, obs=obs)
    inc.log_changes(inc.batch_changes(batch), bronze_path, inc.next_seq(spark, bronze_path))
    (tables.bronze_rejects(raw, ingested_at).observe(bad, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").parquet(f"{bronze_path}_rejects"))
    return spark.createDataFrame([("bronze", _count(obs)), ("bronze_rejects", _count(bad))], "layer string, rows bigint")


def job_silver(spark: SparkSession, bronze_path: str, silver_path: str, fence_method: str = "approx",
               scope: str = "zone") -> DataFrame:
    """Changed months of bronze -> latest per key -> hourly grid per zone ->
    bounded fill -> fences -> flags -> partitions replaced (``incremental``);
    the count is of the rows written."""
    done = inc.refresh_silver(spark, bronze_path, silver_path, fence_method, scope)
    return spark.createDataFrame([("silver", done["rows"])], "layer string, rows bigint")


def job_gold(spark: SparkSession, silver_path: str, gold_path: str, zone_map: dict | None = None) -> DataFrame:
    """Changed months of silver, actual only -> calendar, holidays, lags, rolls
    -> drop -> partitions replaced; the count is of the rows written."""
    done = inc.refresh_gold(spark, silver_path, gold_path, zone_map)
    return spark.createDataFrame([("gold", done["rows"])], "layer string, rows bigint")


def job_train(spark: SparkSession, gold_path: str, model_dir: str, ledger_path: str, test_days: int = 30,
              gbt_params: dict | None = None, seq_len: int = 168, n_trees: int = 200,
              contamination: float = 0.01) -> DataFrame:
    """split -> fit all candidates -> champion -> anomaly model -> ledger rows."""
    gold = tables.scan_layer(spark, gold_path)
    metrics, runs = train_forecasters(gold, test_days, gbt_params, seq_len, save_dir=model_dir)
    recs = ledger_records(metrics, runs)
    scored, nodes, means, offset = an.train_anomaly(gold, n_trees=n_trees, contamination=contamination)
    path = os.path.join(model_dir, "isolation_forest")
    signature = models.save_model(spark, "isolation_forest", (nodes, offset, means, 256), path, gold)
    summ = an.anomaly_summary(scored).first()  # one row
    recs.append({"family": "isolation_forest", "params": {"n_trees": n_trees, "contamination": contamination}, "alias": "anomaly",
                 "metrics": {"anomaly_rate": summ["anomaly_rate"], "n_anomalies": summ["n_anomalies"]},
                 "model_path": path, "signature": signature})
    lg.append_ledger(lg.ledger_rows(spark, recs), ledger_path)
    return metrics


def job_drift(spark: SparkSession, gold_path: str, out_dir: str, ref_days: int = 60, cur_days: int = 7,
              threshold: float = 0.15) -> DataFrame:
    """scan -> windows -> KS tests -> report row + JSON document."""
    gold = tables.scan_layer(spark, gold_path)
    lab = dr.label_windows(gold, ref_days, cur_days, only=True)
    per = dr.fetched(dr.ks_per_feature(lab, DRIFT_FEATURES))
    report = dr.drift_report(lab, DRIFT_FEATURES, threshold, per_feature=per)
    dr.sink_drift_json(dr.report_document(lab, DRIFT_FEATURES, threshold, per_feature=per), out_dir)
    return report


def job_dashboard_tables(spark: SparkSession, gold_path: str, out_dir: str) -> DataFrame:
    """KPIs, last 30 days and hourly profile, written as tables."""
    gold = tables.scan_layer(spark, gold_path)
    kpi = sm.kpi_summary(gold)
    kpi.write.mode("overwrite").parquet(os.path.join(out_dir, "kpi"))
    sm.last_n(gold, 720).select("timestamp_utc", "country", "load_mw_clean", "load_mw_clean_roll_mean_168") \
        .write.mode("overwrite").partitionBy("country").parquet(os.path.join(out_dir, "last_30_days"))
    sm.hourly_profile(gold).write.mode("overwrite").parquet(os.path.join(out_dir, "hourly_profile"))
    return spark.read.parquet(os.path.join(out_dir, "kpi"))


def job_full(spark: SparkSession, root: str, readers: dict[str, Callable[[], DataFrame]], source: str,
             ingested_at, zone_map: dict | None = None, train_kwargs: dict | None = None,
             drift_kwargs: dict | None = None, fence_method: str = "approx") -> DataFrame:
    """The four stages in order, then drift and dashboard tables."""
    p = {k: os.path.join(root, k) for k in ("bronze", "silver", "gold", "models", "ledger", "drift", "dashboard")}
    out = [job_bronze(spark, readers, source, p["bronze"], ingested_at),
           job_silver(spark, p["bronze"], p["silver"], fence_method=fence_method),
           job_gold(spark, p["silver"], p["gold"], zone_map)]
    m = job_train(spark, p["gold"], p["models"], p["ledger"], **(train_kwargs or {}))
    out.append(m.groupBy(F.lit("models").alias("layer")).agg(F.count(F.lit(1)).alias("rows")))
    d = job_drift(spark, p["gold"], p["drift"], **(drift_kwargs or {}))
    out.append(d.select(F.lit("drift").alias("layer"), F.lit(1).cast("bigint").alias("rows")))
    k = job_dashboard_tables(spark, p["gold"], p["dashboard"])
    out.append(k.groupBy(F.lit("dashboard").alias("layer")).agg(F.count(F.lit(1)).alias("rows")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
