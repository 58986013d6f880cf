"""Distribution drift between a reference and a current window.

Tests per feature, all from one table of value counts:

- ``ks``: D = max_v |F_ref(v) - F_cur(v)| and its asymptotic p-value;
- ``wasserstein``: the integral of |F_ref - F_cur| over the gaps between
  values, divided by the reference's standard deviation (at least 0.001);
- ``jensenshannon``: the Jensen-Shannon distance of the value frequencies
  (natural logarithm), meant for few distinct values;
- ``auto``: ``jensenshannon`` up to five distinct values, else ``wasserstein``
  for over 1000 reference rows, else ``ks``.

The distribution functions need running counts in value order.  Distinct values
are counted once (partial aggregates), dealt by range of (feature, value) and
stored with the number of their range.  Totals per range, summed up along the
feature, give each range its offset and the first value of the next one (the
gap across the border); the running count inside a range is added to it.  No
feature is sorted in one task, and results are exact whatever the ranges.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions.stats import ks_pvalue
from loadcast.functions.timecols import report_tag
from loadcast.session import work_dir


def label_windows(df: DataFrame, ref_days: int = 60, cur_days: int = 7, ts: str = "timestamp_utc",
                  only: bool = False) -> DataFrame:
    """drift_window = current / reference / NULL.  The newest time is fetched
    first (one value), so the bounds are literals; with ``only`` rows outside
    both windows are left out, by a filter that reaches the scan."""
    newest = df.agg(F.max(ts)).first()[0]
    if newest is None:
        return df.withColumn("drift_window", F.lit(None).cast("string"))
    cur_start = newest - dt.timedelta(days=cur_days)
    ref_start = cur_start - dt.timedelta(days=ref_days)
    literal = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dict(df.dtypes)[ts])
    t = F.col(ts)
    if only:
        df = df.filter(t >= literal(ref_start))
    return df.withColumn("drift_window", F.when(t >= literal(cur_start), F.lit("current"))
                         .when(t >= literal(ref_start), F.lit("reference")))


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return (df.filter(F.col("drift_window").isNotNull())
            .unpivot(["drift_window"], list(features), "feature", "value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def value_counts(labelled: DataFrame, features: Sequence[str], values_per_range: int = 100_000) -> DataFrame:
    """``(feature, value, cr, cc, part)``: stored counts of every distinct value
    in both windows; ``part`` numbers ranges in order of (feature, value)."""
    spark = labelled.sparkSession
    long = _long(labelled, list(features)).withColumn("value", F.col("value").cast("double"))
    in_window = {c: F.count_if(F.col("drift_window") == w).alias(c) for c, w in (("cr", "reference"), ("cc", "current"))}
    folder = work_dir(spark, "drift-counts")
    long.groupBy("feature", "value").agg(in_window["cr"], in_window["cc"]).write.parquet(f"{folder}/values")
    counts = spark.read.parquet(f"{folder}/values")
    ranges = math.ceil(counts.count() / values_per_range)
    if ranges <= 1:
        return counts.withColumn("part", F.lit(0))
    (counts.repartitionByRange(ranges, "feature", "value").withColumn("part", F.spark_partition_id())
     .write.parquet(f"{folder}/ranges"))
    return spark.read.parquet(f"{folder}/ranges")


def drift_scores(labelled: DataFrame, features: Sequence[str], values_per_range: int = 100_000) -> DataFrame:
    """One row per feature: n_ref, n_cur, n_values and the three scores."""
    vc = value_counts(labelled, features, values_per_range)
    v, every = F.col("value"), Window.partitionBy("feature")
    along = every.orderBy("part")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    tot = (vc.groupBy("feature", "part").agg(F.sum("cr").alias("br"), F.sum("cc").alias("bc"), F.count(F.lit(1)).alias("bn"),
                                             F.sum(F.col("cr") * v).alias("bs"), F.min(v).alias("least"))
           .select("feature", "part", F.coalesce(F.sum("br").over(earlier), F.lit(0)).alias("off_r"),
                   F.coalesce(F.sum("bc").over(earlier), F.lit(0)).alias("off_c"), F.lead("least").over(along).alias("beyond"),
                   F.sum("br").over(every).alias("n_ref"), F.sum("bc").over(every).alias("n_cur"),
                   F.sum("bn").over(every).alias("n_values"), F.try_divide(F.sum("bs").over(every), F.sum("br").over(every)).alias("mean")))
    vc = vc.withColumn("_part", F.xxhash64("feature", "part"))
    inside = Window.partitionBy("_part", "feature", "part").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # Only the join's outcome carries ``beyond``: the last value of a range meets the next range's first.
    cum = (vc.withColumn("next", F.lead(v).over(inside)).withColumn("rr", F.sum("cr").over(upto)).withColumn("rc", F.sum("cc").over(upto))
           .join(tot, ["feature", "part"]))
    away = F.abs(F.try_divide(F.col("off_r") + F.col("rr"), "n_ref") - F.try_divide(F.col("off_c") + F.col("rc"), "n_cur"))
    gap = F.coalesce(F.coalesce("next", "beyond") - v, F.lit(0.0))
    p, q = F.try_divide("cr", "n_ref"), F.try_divide("cc", "n_cur")
    part = lambda x: F.when(x > 0, x * F.log(2 * x / (p + q))).otherwise(F.when(x.isNotNull(), 0.0))
    return (cum.groupBy("feature", "n_ref", "n_cur", "n_values")
            .agg(F.max(away).alias("ks_stat"), F.sum(away * gap).alias("_area"),
                 F.sqrt(F.sum(F.col("cr") * F.pow(v - F.col("mean"), 2)) / F.nullif(F.col("n_ref"), F.lit(0))).alias("_std"),
                 F.sqrt(F.greatest(F.lit(0.0), F.sum(part(p) + part(q)) / 2)).alias("jensenshannon"))
            .select("feature", "n_ref", "n_cur", "n_values", "ks_stat",
                    (F.col("_area") / F.greatest(F.col("_std"), F.lit(0.001))).alias("wasserstein"),
                    F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.col("jensenshannon")).alias("jensenshannon")))


def _p_value() -> F.Column:
    p = ks_pvalue(F.col("ks_stat"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), p)


def ks_per_feature(labelled: DataFrame, features: Sequence[str], alpha: float = 0.05,
                   values_per_range: int = 100_000) -> DataFrame:
    """One row per feature: n_ref, n_cur, ks_stat, p_value, drifted."""
    return (drift_scores(labelled, features, values_per_range).select("feature", "n_ref", "n_cur", "ks_stat")
            .withColumn("p_value", _p_value()).withColumn("drifted", F.col("p_value") < F.lit(alpha)))


def drift_per_feature(labelled: DataFrame, features: Sequence[str], method: str = "auto", alpha: float = 0.05,
                      threshold: float = 0.1, few_values: int = 5, many_rows: int = 1000,
                      values_per_range: int = 100_000) -> DataFrame:
    """One row per feature: method, n_ref, n_cur, score, p_value (``ks`` only)
    and drifted: a p-value below ``alpha``, or a distance of ``threshold`` or more."""
    if method not in ("ks", "wasserstein", "jensenshannon", "auto"):
        raise ValueError(f"unknown drift test: {method}")
    d = drift_scores(labelled, features, values_per_range).withColumn("p_value", _p_value())
    pick = F.lit(method) if method != "auto" else (F.when(F.col("n_values") <= few_values, "jensenshannon")
                                                   .when(F.col("n_ref") > many_rows, "wasserstein").otherwise("ks"))
    d = d.withColumn("method", pick)
    ks = F.col("method") == "ks"
    score = F.when(ks, F.col("ks_stat")).when(F.col("method") == "wasserstein", F.col("wasserstein")).otherwise(F.col("jensenshannon"))
    return (d.withColumn("score", score).withColumn("p_value", F.when(ks, F.col("p_value")))
            .select("feature", "method", "n_ref", "n_cur", "score", "p_value",
                    F.when(ks, F.col("p_value") < alpha).otherwise(F.col("score") >= threshold).alias("drifted")))


def fetched(per_feature: DataFrame) -> DataFrame:
    """The tests as a local table (a row per feature), so that a report, a
    document and a share made from them run them once."""
    spark = per_feature.sparkSession
    return spark.createDataFrame(per_feature.collect(), per_feature.schema)


def drift_share(per_feature: DataFrame, threshold: float = 0.15) -> DataFrame:
    return per_feature.agg(F.avg(F.col("drifted").cast("double")).alias("drift_share"),
                           F.count(F.lit(1)).alias("n_features")).withColumn(
        "drift_detected", F.col("drift_share") >= F.lit(threshold))


def drift_report(labelled: DataFrame, features: Sequence[str], threshold: float = 0.15,
                 min_rows: int = 100, ts: str = "timestamp_utc", per_feature: DataFrame | None = None) -> DataFrame:
    """One row: window sizes, status (ok / insufficient), share and flag."""
    counts = labelled.agg(
        F.max(ts).alias("max_ts"),
        F.sum((F.col("drift_window") == "reference").cast("bigint")).alias("ref_rows"),
        F.sum((F.col("drift_window") == "current").cast("bigint")).alias("cur_rows"))
    # one row (share over <= a few dozen features), fetched as values
    share = drift_share(per_feature if per_feature is not None else ks_per_feature(labelled, features), threshold).first()
    ok = (F.col("ref_rows") >= min_rows) & (F.col("cur_rows") >= min_rows)
    return counts.select(
        "max_ts", report_tag("max_ts").alias("report_tag"), "ref_rows", "cur_rows",
        F.when(ok, F.lit("ok")).otherwise(F.lit("insufficient")).alias("status"),
        F.when(ok, F.lit(share["drift_share"]).cast("double")).otherwise(F.lit(0.0)).alias("drift_share"),
        F.when(ok, F.lit(share["drift_detected"]).cast("boolean")).otherwise(F.lit(False)).alias("drift_detected"))


def report_document(labelled: DataFrame, features: Sequence[str], threshold: float = 0.15,
                    per_feature: DataFrame | None = None) -> DataFrame:
    """The drift result as one nested document: a ``metrics`` array with one
    entry per feature and one dataset entry carrying the share."""
    per = per_feature if per_feature is not None else fetched(ks_per_feature(labelled, features))
    sh = drift_share(per, threshold).first()  # one row
    tag = labelled.select(report_tag(F.max("timestamp_utc"))).first()[0]
    col_metrics = per.agg(F.sort_array(F.collect_list(F.struct(
        F.col("feature").alias("column_name"), F.col("ks_stat").alias("drift_score"),
        F.col("p_value"), F.col("drifted").alias("drift_detected")))).alias("cols"))
    return col_metrics.select(
        F.lit(tag).alias("tag"),
        F.concat(
            F.transform("cols", lambda c: F.struct(F.lit("ColumnDriftMetric").alias("metric"),
                                                   F.struct(c["column_name"].alias("column_name"),
                                                            c["drift_score"].alias("drift_score"),
                                                            c["p_value"].alias("p_value"),
                                                            c["drift_detected"].alias("drift_detected"),
                                                            F.lit(None).cast("double").alias("share_of_drifted_columns"),
                                                            F.lit(None).cast("bigint").alias("number_of_columns")).alias("result"))),
            F.array(F.struct(F.lit("DatasetDriftMetric").alias("metric"),
                             F.struct(F.lit(None).cast("string").alias("column_name"),
                                      F.lit(None).cast("double").alias("drift_score"),
                                      F.lit(None).cast("double").alias("p_value"),
                                      F.lit(sh["drift_detected"]).cast("boolean").alias("drift_detected"),
                                      F.lit(sh["drift_share"]).cast("double").alias("share_of_drifted_columns"),
                                      F.lit(sh["n_features"]).cast("bigint").alias("number_of_columns")).alias("result")))
        ).alias("metrics"))


def sink_drift_json(doc: DataFrame, folder: str) -> str:
    """Write the document as ``drift_<tag>.json`` (a folder of JSON parts)."""
    tag = doc.select("tag").first()[0]  # one short string from a one-row result
    path = f"{folder.rstrip('/')}/drift_{tag}.json"
    doc.coalesce(1).write.mode("overwrite").json(path)
    return path


def scan_drift_json(spark, path: str) -> DataFrame:
    """First metric (in document order) that carries share_of_drifted_columns."""
    doc = spark.read.json(path)
    m = doc.select(F.posexplode("metrics").alias("pos", "m"))
    hit = m.filter(F.col("m.result.share_of_drifted_columns").isNotNull())
    return hit.agg(F.min_by(F.col("m.result.share_of_drifted_columns"), F.col("pos")).alias("drift_share"))
