"""M8 anomalies, attribution and batch scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.operators import anomaly as an
from loadcast.operators import attribution as at
from loadcast.operators import evaluate as ev
from loadcast.operators import forecast as fc
from loadcast.operators import models
from loadcast.operators import scoring as sc
from loadcast.plans import jobs, layers
from loadcast.present import finish
from loadcast.queries.q_forecast import GBT_QUICK, TEST_DAYS, split
from loadcast.registry import query
from loadcast.schemas import ANOMALY_FEATURES, FEATURE_COLS
from loadcast.session import work_dir

W = O.with_
R = O.rnd
GOLD = O.silver_ctes() + O.gold_ctes()
GOLD_ALL = O.silver_ctes() + O.gold_ctes(drop=False)
CUT = f"(SELECT max(timestamp_utc) - INTERVAL {TEST_DAYS} DAY FROM gold)"
KEY = ["timestamp_utc", "country"]
QUICK_TREES = 200
SAMPLE_ROWS = 2000     # rows that attribution explains (the operator's definition)
BACKGROUND_ROWS = 64   # rows that stand in for absent features


def _sel(cols):
    return ", ".join(f"{R(c)} AS {c}" if c.startswith("load_mw") else f"{c}" for c in cols)


@query("anomaly_matrix", W(*GOLD) + f"\nSELECT timestamp_utc, country, {_sel(ANOMALY_FEATURES)} FROM gold WHERE "
       + " AND ".join(f"{c} IS NOT NULL" for c in ANOMALY_FEATURES))
def anomaly_matrix(spark, sf_dir):
    g = layers.gold_grid(spark, sf_dir)
    m = fc.assembler(ANOMALY_FEATURES, "features").transform(g)
    return finish(m.select(*KEY, *ANOMALY_FEATURES))


@query("impute_mean", W(*GOLD_ALL, ("train", f"SELECT * FROM gold WHERE timestamp_utc <= {CUT}"))
       + "\nSELECT timestamp_utc, country, " + ", ".join(
           f"{R(f'coalesce({c}, (SELECT avg({c}) FROM train))')} AS {c}" if c.startswith("load_mw")
           else f"coalesce({c}, CAST((SELECT avg({c}) FROM train) AS BIGINT)) AS {c}" for c in ANOMALY_FEATURES)
       + " FROM gold")
def impute_mean(spark, sf_dir):
    """Training means (train split) fill the missing lags/rolls of every row."""
    g = layers.gold_grid(spark, sf_dir, drop=False)
    train = g.filter(F.col("timestamp_utc") <= ev.cutoff(g, TEST_DAYS))
    cols = [c for c in ANOMALY_FEATURES if c.startswith("load_mw")]
    return finish(an.impute(g, cols, an.impute_means(train, cols)).select(*KEY, *ANOMALY_FEATURES))


def _forest(spark, sf_dir, contamination=0.01):
    g = layers.gold_table(spark, sf_dir)
    return an.train_anomaly(g, n_trees=QUICK_TREES, contamination=contamination)


@query("fit_isolation_forest")
def fit_isolation_forest(spark, sf_dir):
    g = layers.gold_grid(spark, sf_dir)
    nodes = an.fit_forest(g, n_trees=QUICK_TREES)
    return nodes.groupBy("tree_id").agg(F.count(F.lit(1)).alias("nodes"), F.max("depth").alias("max_depth"),
                                        F.max("size").alias("sample_size"))


@query("score_isolation_forest")
def score_isolation_forest(spark, sf_dir):
    scored, *_ = _forest(spark, sf_dir)
    return finish(scored.select(*KEY, "load_mw_clean", "anomaly_score", "is_anomaly"))


@query("anomaly_summary")
def anomaly_summary(spark, sf_dir):
    scored, *_ = _forest(spark, sf_dir)
    return finish(an.anomaly_summary(scored))


@query("train_anomaly")
def train_anomaly(spark, sf_dir):
    """Fit, score and summarise (contamination 0.05, as in the unit test)."""
    scored, nodes, *_ = _forest(spark, sf_dir, contamination=0.05)
    s = an.anomaly_summary(scored)
    return finish(s.withColumn("n_trees", nodes.select(F.countDistinct("tree_id")).scalar()))


@query("sample_n", W(*GOLD) + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS load_mw_clean FROM gold WHERE timestamp_utc > {CUT}
ORDER BY md5(CAST(timestamp_utc AS VARCHAR) || '|' || country || '|42'), timestamp_utc, country LIMIT {SAMPLE_ROWS}""")
def sample_n(spark, sf_dir):
    _, test = split(spark, sf_dir)
    return finish(at.sample_n(test, SAMPLE_ROWS, KEY).select(*KEY, "load_mw_clean"))


def _attribution(spark, sf_dir):
    train, test = split(spark, sf_dir)
    model = fc.fit_gbt(train, **GBT_QUICK)
    rows = at.sample_n(test, SAMPLE_ROWS, KEY)
    background = at.sample_n(train, BACKGROUND_ROWS, KEY, seed=11)
    return at.sampled_shapley(model, rows, background, FEATURE_COLS, KEY)


@query("attribution_sampled")
def attribution_sampled(spark, sf_dir):
    return finish(_attribution(spark, sf_dir))


@query("mean_abs_attribution")
def mean_abs_attribution(spark, sf_dir):
    return finish(at.mean_abs_attribution(_attribution(spark, sf_dir)))


def _exact(spark, sf_dir):
    """Exact tree attribution of the sampled rows by the fitted boosting."""
    train, test = split(spark, sf_dir)
    model = fc.fit_gbt(train, **GBT_QUICK)
    rows = layers.materialize(at.sample_n(test, SAMPLE_ROWS, KEY), "explained")
    phi, baseline = at.tree_attribution(model.stages[-1], rows, FEATURE_COLS, KEY)
    return model, rows, phi, baseline


@query("attribution_exact")
def attribution_exact(spark, sf_dir):
    return finish(_exact(spark, sf_dir)[2])


_SAMPLED = f"""SELECT timestamp_utc, country FROM gold WHERE timestamp_utc > {CUT}
ORDER BY md5(CAST(timestamp_utc AS VARCHAR) || '|' || country || '|42'), timestamp_utc, country LIMIT {SAMPLE_ROWS}"""


@query("attribution_additivity", W(*GOLD) + f"""
SELECT timestamp_utc, country, CAST({len(FEATURE_COLS)} AS BIGINT) AS n_features, true AS adds_up FROM ({_SAMPLED}) s""")
def attribution_additivity(spark, sf_dir):
    """Values of a row add up to its prediction less the baseline."""
    model, rows, phi, baseline = _exact(spark, sf_dir)
    sums = phi.groupBy(*KEY).agg(F.sum("phi").alias("total"), F.count(F.lit(1)).alias("n_features"))
    pred = fc.predict(model, rows).select(*KEY, "prediction")
    gap = F.abs(F.col("total") + F.lit(baseline) - F.col("prediction"))
    return finish(sums.join(pred, KEY).select(*KEY, "n_features", (gap <= 1e-9 * F.greatest(F.abs("prediction"), F.lit(1.0))).alias("adds_up")))


@query("mean_abs_exact")
def mean_abs_exact(spark, sf_dir):
    return finish(at.mean_abs_attribution(_exact(spark, sf_dir)[2]))


@query("sink_csv")
def sink_csv(spark, sf_dir):
    """Importances written as CSV with a header, read back."""
    train, _ = split(spark, sf_dir)
    model = fc.fit_gbt(train, **GBT_QUICK)
    path = work_dir(spark, "importance_csv")
    fc.importance_rank(fc.gbt_importance(spark, model)).coalesce(1).write.option("header", True).mode("overwrite").csv(path)
    return spark.read.option("header", True).schema("feature string, importance double, rank int").csv(path)


def _forecast_request(spark, sf_dir, g=None):
    g = layers.gold_grid(spark, sf_dir, drop=False) if g is None else g
    return sc.as_request(g, sc.FORECAST_REQUEST, extra=[F.to_date("timestamp_utc").cast("string").alias("batch_id"), "country"])


def _anomaly_request(spark, sf_dir, g=None):
    g = layers.gold_grid(spark, sf_dir, drop=False) if g is None else g
    return sc.as_request(g, sc.ANOMALY_REQUEST, extra=[F.to_date("timestamp_utc").cast("string").alias("batch_id")])


def _invalid_sql(fields):
    return " OR ".join(f"{f} IS NULL" for f in fields)


_FR = [f.name for f in sc.FORECAST_REQUEST.fields]
_AR = [f.name for f in sc.ANOMALY_REQUEST.fields]


@query("score_request_check", W(*GOLD_ALL) + f"""
SELECT CAST(CAST(timestamp_utc AS DATE) AS VARCHAR) AS batch_id, count(*) AS n_rows,
       sum(CASE WHEN {_invalid_sql(_FR)} THEN 0 ELSE 1 END) AS n_valid,
       sum(CASE WHEN {_invalid_sql(_FR)} THEN 1 ELSE 0 END) AS n_invalid,
       CASE WHEN count(*) BETWEEN 1 AND {sc.MAX_ROWS} THEN 'ok' ELSE 'rejected' END AS batch_status
FROM gold GROUP BY 1""")
def score_request_check(spark, sf_dir):
    """Forecast requests in daily batches: rows with a missing lag/roll are invalid."""
    chk = sc.check_request(_forecast_request(spark, sf_dir), sc.FORECAST_REQUEST)
    return finish(sc.batch_report(chk))


_TRAINED: dict[tuple[str, str], tuple[str, str]] = {}


def _registered(spark, sf_dir):
    """Ledger of all candidates and of the forest, trained on the gold table;
    once per application and data folder (the models are stored)."""
    key = spark.sparkContext.applicationId, sf_dir
    if key in _TRAINED:
        ledger, gold = _TRAINED[key]
        return ledger, spark.read.parquet(gold)
    d = work_dir(spark, "registered")
    layers.gold_grid(spark, sf_dir, drop=False).write.parquet(f"{d}/gold")
    jobs.job_train(spark, f"{d}/gold", f"{d}/models", f"{d}/ledger", test_days=TEST_DAYS, gbt_params=GBT_QUICK, n_trees=QUICK_TREES)
    _TRAINED[key] = f"{d}/ledger", f"{d}/gold"
    return f"{d}/ledger", spark.read.parquet(f"{d}/gold")


def _valid(spark, sf_dir, request, schema):
    rows = sc.check_request(request, schema).filter("valid")
    return rows.withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp_ntz")).withColumn("kind", F.lit("actual"))


@query("batch_forecast")
def batch_forecast(spark, sf_dir):
    """The champion, found by its alias in the ledger, scores the valid request rows."""
    ledger, g = _registered(spark, sf_dir)
    rows = _valid(spark, sf_dir, _forecast_request(spark, sf_dir, g), sc.FORECAST_REQUEST)
    return finish(models.score_by_alias(spark, ledger, "champion", rows, history=g).select("timestamp_utc", "country", "prediction"))


@query("batch_forecast_rows", W(*GOLD_ALL) + f"""
SELECT timestamp_utc, country, true AS scored
FROM gold WHERE NOT ({" OR ".join(f"{f.name} IS NULL" for f in sc.FORECAST_REQUEST.fields)})""")
def batch_forecast_rows(spark, sf_dir):
    """Every valid request row is scored by the registered champion."""
    out = batch_forecast(spark, sf_dir)
    return out.select("timestamp_utc", "country", F.col("prediction").isNotNull().alias("scored"))


@query("batch_anomaly")
def batch_anomaly(spark, sf_dir):
    """The registered forest, by its alias, scores anomaly requests (continuous
    score and flag, training-mean imputation)."""
    ledger, g = _registered(spark, sf_dir)
    rows = _valid(spark, sf_dir, _anomaly_request(spark, sf_dir, g), sc.ANOMALY_REQUEST)
    return finish(models.score_by_alias(spark, ledger, "anomaly", rows).select("timestamp_utc", "country", "anomaly_score", "is_anomaly"))


def _counter_sql(endpoint, fields):
    return f"""SELECT '{endpoint}' AS endpoint, CASE WHEN {_invalid_sql(fields)} THEN 'invalid_row' ELSE 'scored' END AS status, count(*) AS n
FROM gold GROUP BY 2"""


@query("score_counters", W(*GOLD_ALL) + "\n" + _counter_sql("forecast", _FR) + "\nUNION ALL\n" + _counter_sql("anomaly", _AR))
def score_counters(spark, sf_dir):
    f = sc.score_counters(sc.check_request(_forecast_request(spark, sf_dir), sc.FORECAST_REQUEST), "forecast")
    a = sc.score_counters(sc.check_request(_anomaly_request(spark, sf_dir), sc.ANOMALY_REQUEST), "anomaly")
    return finish(f.unionByName(a))
