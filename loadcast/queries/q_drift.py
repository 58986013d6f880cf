"""M6 drift: windows, KS per feature, share, report, JSON sink and scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.operators import drift as dr
from loadcast.plans import layers
from loadcast.present import finish
from loadcast.registry import query
from loadcast.schemas import DRIFT_FEATURES
from loadcast.session import work_dir

W = O.with_
R = O.rnd
REF_DAYS, CUR_DAYS = 60, 7  # the operator's defaults
GOLD = O.silver_ctes() + O.gold_ctes()
MX = "(SELECT max(timestamp_utc) FROM gold)"


def _labelled(spark, sf_dir, only=True):
    return dr.label_windows(layers.gold_table(spark, sf_dir), REF_DAYS, CUR_DAYS, only=only)


def _pvalue_sql(d="ks_stat", n="n_ref", m="n_cur", terms=6):
    """SQL twin of ``stats.ks_pvalue``."""
    import math
    ne = f"(CAST({n} AS DOUBLE) * {m} / ({n} + {m}))"
    lam = f"((sqrt({ne}) + 0.12 + 0.11 / sqrt({ne})) * {d})"
    small = " + ".join(f"exp({-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0!r} / ({lam} * {lam}))" for k in range(1, terms + 1))
    large = " + ".join(f"({2.0 * (-1) ** (k - 1)!r} * exp({-2.0 * k * k!r} * {lam} * {lam}))" for k in range(1, terms + 1))
    q = (f"CASE WHEN {lam} < 0.001 THEN 1.0 WHEN {lam} < 1.18 THEN 1.0 - {math.sqrt(2 * math.pi)!r} / {lam} * ({small}) "
         f"ELSE {large} END")
    return f"least(1.0, greatest(0.0, {q}))"


def ks_ctes(features, gold=None):
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in features)
    return (gold or GOLD) + [
        ("lab", f"""SELECT *, CASE WHEN timestamp_utc >= {MX} - INTERVAL {CUR_DAYS} DAY THEN 'current'
  WHEN timestamp_utc >= {MX} - INTERVAL {CUR_DAYS + REF_DAYS} DAY AND timestamp_utc < {MX} - INTERVAL {CUR_DAYS} DAY THEN 'reference' END AS drift_window FROM gold"""),
        ("wide", f"SELECT drift_window, {casts} FROM lab WHERE drift_window IS NOT NULL"),
        ("long", f"SELECT drift_window, feature, value FROM (UNPIVOT wide ON {', '.join(features)} INTO NAME feature VALUE value) u WHERE value IS NOT NULL AND NOT isnan(value)"),
        ("vc", """SELECT feature, value, sum(CASE WHEN drift_window = 'reference' THEN 1 ELSE 0 END) AS cr,
  sum(CASE WHEN drift_window = 'current' THEN 1 ELSE 0 END) AS cc FROM long GROUP BY feature, value"""),
        ("nn", "SELECT feature, sum(cr) AS n_ref, sum(cc) AS n_cur FROM vc GROUP BY feature"),
        ("cum", """SELECT feature, sum(cr) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS rr,
  sum(cc) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS rc FROM vc"""),
        ("ks0", "SELECT feature, n_ref, n_cur, max(abs(rr / n_ref - rc / n_cur)) AS ks_stat FROM cum JOIN nn USING (feature) GROUP BY 1, 2, 3"),
        ("ks", f"SELECT *, {_pvalue_sql()} AS p_value FROM ks0"),
        ("ksd", "SELECT *, p_value < 0.05 AS drifted FROM ks"),
    ]


KS_SEL = f"feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, {R('ks_stat')} AS ks_stat, {R('p_value')} AS p_value, drifted"


@query("drift_windows", W(*GOLD) + f"""
SELECT timestamp_utc, country, CASE WHEN timestamp_utc >= {MX} - INTERVAL {CUR_DAYS} DAY THEN 'current'
  WHEN timestamp_utc >= {MX} - INTERVAL {CUR_DAYS + REF_DAYS} DAY AND timestamp_utc < {MX} - INTERVAL {CUR_DAYS} DAY THEN 'reference' END AS drift_window
FROM gold""")
def drift_windows(spark, sf_dir):
    return finish(_labelled(spark, sf_dir, only=False).select("timestamp_utc", "country", "drift_window"))


@query("drift_per_feature", W(*ks_ctes(DRIFT_FEATURES)) + f"\nSELECT {KS_SEL} FROM ksd")
def drift_per_feature(spark, sf_dir):
    return finish(dr.ks_per_feature(_labelled(spark, sf_dir), DRIFT_FEATURES))


@query("target_drift", W(*ks_ctes(["load_mw_clean"])) + f"\nSELECT {KS_SEL} FROM ksd")
def target_drift(spark, sf_dir):
    return finish(dr.ks_per_feature(_labelled(spark, sf_dir), ["load_mw_clean"]))


def scores_ctes(features):
    """The three distances in SQL: distribution functions and frequencies over the pooled values."""
    return ks_ctes(features) + [
        ("dist", """SELECT vc.feature, value, cr / n_ref AS p, cc / n_cur AS q, cr, n_ref,
  sum(cr) OVER w / n_ref AS f, sum(cc) OVER w / n_cur AS g, lead(value) OVER (PARTITION BY vc.feature ORDER BY value) - value AS gap,
  count(*) OVER (PARTITION BY vc.feature) AS n_values
FROM vc JOIN nn USING (feature) WINDOW w AS (PARTITION BY vc.feature ORDER BY value ROWS UNBOUNDED PRECEDING)"""),
        ("sds", "SELECT feature, stddev_pop(value) AS sd FROM long WHERE drift_window = 'reference' GROUP BY feature"),
        ("dd", """SELECT feature, n_values, sum(abs(f - g) * coalesce(gap, 0)) / greatest(max(sd), 0.001) AS wasserstein,
  sqrt(greatest(0.0, sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2)) AS jensenshannon
FROM dist JOIN sds USING (feature) GROUP BY feature, n_values"""),
        ("scored", "SELECT * FROM ksd JOIN dd USING (feature)"),
    ]


def _scores_sql(method, features=DRIFT_FEATURES):
    """``method``: a test's name, or SQL that gives one per feature."""
    return W(*scores_ctes(features), ("picked", f"SELECT *, {method} AS method FROM scored"),
             ("judged", """SELECT *, CASE method WHEN 'ks' THEN ks_stat WHEN 'wasserstein' THEN wasserstein ELSE jensenshannon END AS score FROM picked""")) + f"""
SELECT feature, method, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, {R('score')} AS score,
       CASE WHEN method = 'ks' THEN {R('p_value')} END AS p_value, CASE WHEN method = 'ks' THEN p_value < 0.05 ELSE score >= 0.1 END AS drifted FROM judged"""


@query("drift_wasserstein", _scores_sql("'wasserstein'"))
def drift_wasserstein(spark, sf_dir):
    return finish(dr.drift_per_feature(_labelled(spark, sf_dir), DRIFT_FEATURES, "wasserstein"))


#: Features of few values: frequencies say something about these.
CATEGORIES = ["hour", "day_of_week", "is_weekend"]


@query("drift_jensenshannon", _scores_sql("'jensenshannon'", CATEGORIES))
def drift_jensenshannon(spark, sf_dir):
    return finish(dr.drift_per_feature(_labelled(spark, sf_dir), CATEGORIES, "jensenshannon"))


@query("drift_auto", _scores_sql("CASE WHEN n_values <= 5 THEN 'jensenshannon' WHEN n_ref > 1000 THEN 'wasserstein' ELSE 'ks' END"))
def drift_auto(spark, sf_dir):
    """Each feature by the test its distinct values and rows call for."""
    return finish(dr.drift_per_feature(_labelled(spark, sf_dir), DRIFT_FEATURES))


SHARE_SQL = W(*ks_ctes(DRIFT_FEATURES)) + f"""
SELECT {R('avg(CAST(drifted AS DOUBLE))')} AS drift_share, count(*) AS n_features, avg(CAST(drifted AS DOUBLE)) >= 0.15 AS drift_detected FROM ksd"""


@query("drift_share", SHARE_SQL)
def drift_share(spark, sf_dir):
    return finish(dr.drift_share(dr.ks_per_feature(_labelled(spark, sf_dir), DRIFT_FEATURES)))


def report_sql(gold=None):
    return W(*ks_ctes(DRIFT_FEATURES, gold),
             ("sh", "SELECT avg(CAST(drifted AS DOUBLE)) AS s FROM ksd"),
             ("cn", "SELECT max(timestamp_utc) AS max_ts, sum(CASE WHEN drift_window = 'reference' THEN 1 ELSE 0 END) AS ref_rows, sum(CASE WHEN drift_window = 'current' THEN 1 ELSE 0 END) AS cur_rows FROM lab")) + f"""
SELECT max_ts, strftime(max_ts, '%Y%m%d_%H%M') AS report_tag, CAST(ref_rows AS BIGINT) AS ref_rows, CAST(cur_rows AS BIGINT) AS cur_rows,
  CASE WHEN ref_rows >= 100 AND cur_rows >= 100 THEN 'ok' ELSE 'insufficient' END AS status,
  {R("CASE WHEN ref_rows >= 100 AND cur_rows >= 100 THEN (SELECT s FROM sh) ELSE 0.0 END")} AS drift_share,
  CASE WHEN ref_rows >= 100 AND cur_rows >= 100 THEN (SELECT s FROM sh) >= 0.15 ELSE false END AS drift_detected
FROM cn"""


@query("drift_report", report_sql())
def drift_report(spark, sf_dir):
    return finish(dr.drift_report(_labelled(spark, sf_dir), DRIFT_FEATURES))


def _written(spark, sf_dir):
    doc = dr.report_document(_labelled(spark, sf_dir), DRIFT_FEATURES)
    return dr.sink_drift_json(doc, work_dir(spark, "drift"))


@query("sink_drift_json", W(*ks_ctes(DRIFT_FEATURES)) + f"""
SELECT 'ColumnDriftMetric' AS metric, feature AS column_name, {R('ks_stat')} AS drift_score, {R('p_value')} AS p_value,
       drifted AS drift_detected, CAST(NULL AS DOUBLE) AS share_of_drifted_columns FROM ksd
UNION ALL
SELECT 'DatasetDriftMetric', NULL, NULL, NULL, avg(CAST(drifted AS DOUBLE)) >= 0.15, {R('avg(CAST(drifted AS DOUBLE))')} FROM ksd""")
def sink_drift_json(spark, sf_dir):
    path = _written(spark, sf_dir)
    m = spark.read.json(path).select(F.explode("metrics").alias("m"))
    return finish(m.select(F.col("m.metric").alias("metric"), F.col("m.result.column_name").alias("column_name"),
                           F.col("m.result.drift_score").alias("drift_score"), F.col("m.result.p_value").alias("p_value"),
                           F.col("m.result.drift_detected").alias("drift_detected"),
                           F.col("m.result.share_of_drifted_columns").alias("share_of_drifted_columns")))


@query("scan_drift_json", W(*ks_ctes(DRIFT_FEATURES)) + f"\nSELECT {R('avg(CAST(drifted AS DOUBLE))')} AS drift_share FROM ksd")
def scan_drift_json(spark, sf_dir):
    return finish(dr.scan_drift_json(spark, _written(spark, sf_dir)))
