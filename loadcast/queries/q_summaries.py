"""M3 dashboard tables and M5 evaluation over the gold fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.operators import evaluate as ev
from loadcast.operators import summaries as sm
from loadcast.plans import layers
from loadcast.present import finish
from loadcast.registry import query
from loadcast.sources import testdata as td

W = O.with_
R = O.rnd
SILVER = O.silver_ctes()
GOLD = SILVER + O.gold_ctes()
GOLD_ALL = SILVER + O.gold_ctes(drop=False)
US_FIXTURE = sorted(z for z, c in td.FIXTURE_ZONE_MAP.items() if c == "US")

# ---------------------------------------------------------------- M3

@query("kpi_summary", W(*GOLD) + f"""
SELECT country, count(*) AS records, {R('avg(load_mw_clean)')} AS avg_load, {R('max(load_mw_clean)')} AS peak_load,
       strftime(min(timestamp_utc), '%Y-%m-%d') AS first_date, strftime(max(timestamp_utc), '%Y-%m-%d') AS last_date
FROM gold GROUP BY country""")
def kpi_summary(spark, sf_dir):
    return finish(sm.kpi_summary(layers.gold_grid(spark, sf_dir)))


@query("hourly_profile", W(*GOLD) + f"""
SELECT country, hour, {R('quantile_cont(load_mw_clean, 0.5)')} AS median, {R('quantile_cont(load_mw_clean, 0.25)')} AS q25,
       {R('quantile_cont(load_mw_clean, 0.75)')} AS q75
FROM gold GROUP BY country, hour""")
def hourly_profile(spark, sf_dir):
    return finish(sm.hourly_profile(layers.gold_grid(spark, sf_dir)))


@query("last_30_days", W(*GOLD) + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS load_mw_clean, {R('load_mw_clean_roll_mean_168')} AS load_mw_clean_roll_mean_168
FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY timestamp_utc DESC) AS rn FROM gold) t WHERE rn <= 720""")
def last_30_days(spark, sf_dir):
    g = layers.gold_grid(spark, sf_dir)
    return finish(sm.last_n(g, 720).select("timestamp_utc", "country", "load_mw_clean", "load_mw_clean_roll_mean_168"))


@query("latest_10", W(*SILVER) + f"""
SELECT timestamp_utc, country, {R('load_mw')} AS load_mw, {R('load_mw_clean')} AS load_mw_clean
FROM silver ORDER BY timestamp_utc DESC, country ASC LIMIT 10""")
def latest_10(spark, sf_dir):
    s = layers.silver_grid(spark, sf_dir)
    return finish(sm.latest(s, 10).select("timestamp_utc", "country", "load_mw", "load_mw_clean"))


@query("preview", W(*GOLD) + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS load_mw_clean, hour, day_of_week
FROM gold ORDER BY timestamp_utc, country LIMIT 5""")
def preview(spark, sf_dir):
    g = layers.gold_grid(spark, sf_dir)
    return finish(sm.preview(g, 5).select("timestamp_utc", "country", "load_mw_clean", "hour", "day_of_week"))


@query("zone_list", W(*GOLD) + "\nSELECT DISTINCT country FROM gold")
def zone_list(spark, sf_dir):
    return finish(sm.zone_list(layers.gold_grid(spark, sf_dir)))


@query("zone_count", W(*GOLD) + "\nSELECT count(DISTINCT country) AS n_zones FROM gold")
def zone_count(spark, sf_dir):
    return finish(sm.zone_count(layers.gold_grid(spark, sf_dir)))


@query("region_filter", W(*GOLD) + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS load_mw_clean, {R('load_mw_clean_lag_24')} AS load_mw_clean_lag_24
FROM gold WHERE country = 'view'""")
def region_filter(spark, sf_dir):
    g = layers.gold_grid(spark, sf_dir)
    return finish(sm.region_filter(g, "view").select("timestamp_utc", "country", "load_mw_clean", "load_mw_clean_lag_24"))


@query("series_extent", W(("h", O.LOAD_HOURLY)) + """
SELECT country, count(*) AS rows, min(timestamp_utc) AS min_ts, max(timestamp_utc) AS max_ts FROM h GROUP BY country""")
def series_extent(spark, sf_dir):
    return finish(sm.series_extent(td.load_hourly(spark, sf_dir)))


@query("max_timestamp", W(*SILVER) + "\nSELECT max(timestamp_utc) AS max_ts FROM silver")
def max_timestamp(spark, sf_dir):
    return finish(sm.max_timestamp(layers.silver_grid(spark, sf_dir)))


@query("source_label", W(*GOLD) + f"""
SELECT DISTINCT country, CASE WHEN country IN ({', '.join(repr(z) for z in US_FIXTURE)}) THEN 'EIA Open Data'
       ELSE 'ENTSO-E Transparency Platform' END AS source FROM gold""")
def source_label(spark, sf_dir):
    g = layers.gold_grid(spark, sf_dir)
    return finish(g.select("country", sm.source_label("country", US_FIXTURE).alias("source")).distinct())


# ---------------------------------------------------------------- M5
# Candidate forecasts are column expressions over gold: mean of train,
# same hour yesterday (lag 24), previous-day moving average.

TEST_DAYS = 7
CUT = f"(SELECT max(timestamp_utc) - INTERVAL {TEST_DAYS} DAY FROM gold)"
MODELS = ["mean", "seasonal_naive", "moving_average_24"]


def _split(spark, sf_dir, drop=True):
    return ev.time_split(layers.gold_grid(spark, sf_dir, drop=drop), TEST_DAYS)


def _candidates(spark, sf_dir):
    g = _split(spark, sf_dir).withColumn("y", F.col("load_mw_clean"))
    train, test = g.filter("split = 'train'"), g.filter("split = 'test'")
    mean = ev.mean_baseline(train, test).withColumn("model", F.lit("mean"))
    naive = test.withColumn("prediction", F.col("load_mw_clean_lag_24")).withColumn("model", F.lit("seasonal_naive"))
    mavg = test.withColumn("prediction", F.col("load_mw_clean_roll_mean_24")).withColumn("model", F.lit("moving_average_24"))
    cols = ["timestamp_utc", "country", "model", "y", "prediction"]
    return mean.select(*cols).unionByName(naive.select(*cols)).unionByName(mavg.select(*cols))


def _metric_sql(y="y", p="prediction"):
    return (f"{R(f'avg(abs({y} - {p}) / greatest(abs({y}), 2.220446049250313e-16))')} AS mape, "
            f"{R(f'sqrt(avg(({y} - {p}) * ({y} - {p})))')} AS rmse, {R(f'avg(abs({y} - {p}))')} AS mae, count(*) AS n")


CAND_SQL = GOLD + [
    ("train", f"SELECT * FROM gold WHERE timestamp_utc <= {CUT}"),
    ("test", f"SELECT * FROM gold WHERE timestamp_utc > {CUT}"),
    ("cand", """SELECT timestamp_utc, country, 'mean' AS model, load_mw_clean AS y, (SELECT avg(load_mw_clean) FROM train) AS prediction FROM test
UNION ALL SELECT timestamp_utc, country, 'seasonal_naive', load_mw_clean, load_mw_clean_lag_24 FROM test
UNION ALL SELECT timestamp_utc, country, 'moving_average_24', load_mw_clean, load_mw_clean_roll_mean_24 FROM test"""),
    ("metrics", f"SELECT model, {_metric_sql()} FROM cand GROUP BY model"),
]


@query("time_split", W(*GOLD) + f"\nSELECT timestamp_utc, country, CASE WHEN timestamp_utc <= {CUT} THEN 'train' ELSE 'test' END AS split FROM gold")
def time_split(spark, sf_dir):
    return finish(_split(spark, sf_dir).select("timestamp_utc", "country", "split"))


@query("tail_fraction_split", W(*GOLD) + """
SELECT timestamp_utc, country, CASE WHEN row_number() OVER (PARTITION BY country ORDER BY timestamp_utc)
       <= floor(0.9 * count(*) OVER (PARTITION BY country)) THEN 'train' ELSE 'validation' END AS split FROM gold""")
def tail_fraction_split(spark, sf_dir):
    g = layers.gold_grid(spark, sf_dir)
    return finish(ev.tail_fraction_split(g, 0.9).select("timestamp_utc", "country", "split"))


@query("forecast_metrics", W(*CAND_SQL) + f"\nSELECT model, country, {_metric_sql()} FROM cand GROUP BY model, country")
def forecast_metrics(spark, sf_dir):
    return finish(ev.forecast_metrics(_candidates(spark, sf_dir), by=["model", "country"]))


@query("mean_baseline", W(*CAND_SQL) + f"\nSELECT {_metric_sql()} FROM cand WHERE model = 'mean'")
def mean_baseline(spark, sf_dir):
    return finish(ev.forecast_metrics(_candidates(spark, sf_dir).filter("model = 'mean'")))


@query("seasonal_naive_baseline", W(*CAND_SQL) + f"\nSELECT {_metric_sql()} FROM cand WHERE model = 'seasonal_naive'")
def seasonal_naive_baseline(spark, sf_dir):
    return finish(ev.forecast_metrics(_candidates(spark, sf_dir).filter("model = 'seasonal_naive'")))


@query("mask_valid_predictions", W(*GOLD_ALL) + f"""
SELECT {_metric_sql('load_mw_clean', 'load_mw_clean_lag_168')} FROM gold
WHERE load_mw_clean_lag_168 IS NOT NULL AND NOT isnan(load_mw_clean_lag_168)""")
def mask_valid_predictions(spark, sf_dir):
    """Weekly-naive predictions exist only after the first 168 rows: score those."""
    g = layers.gold_grid(spark, sf_dir, drop=False).withColumn("prediction", F.col("load_mw_clean_lag_168"))
    return finish(ev.forecast_metrics(ev.mask_valid(g), y="load_mw_clean"))


_ORDER_CASE = "CASE model " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MODELS)) + " END"


@query("champion_pick", W(*CAND_SQL) + f"""
SELECT model, mape FROM (SELECT model, mape FROM metrics ORDER BY mape, {_ORDER_CASE} LIMIT 1) t""")
def champion_pick(spark, sf_dir):
    m = finish(ev.forecast_metrics(_candidates(spark, sf_dir), by=["model"]))
    return finish(ev.champion_pick(m, MODELS))


@query("run_summary", W(*CAND_SQL) + f"""
SELECT model, mape, rmse, mae, n, model = (SELECT model FROM metrics ORDER BY mape, {_ORDER_CASE} LIMIT 1) AS is_champion FROM metrics""")
def run_summary(spark, sf_dir):
    m = finish(ev.forecast_metrics(_candidates(spark, sf_dir), by=["model"]))
    return finish(ev.run_summary(m, MODELS))


@query("min_rows_guard", W(*GOLD) + f"""
SELECT country, count(*) AS n, CASE WHEN count(*) < 100 THEN 'insufficient' ELSE 'ok' END AS status
FROM gold WHERE timestamp_utc > (SELECT max(timestamp_utc) - INTERVAL 1 DAY FROM gold) GROUP BY country""")
def min_rows_guard(spark, sf_dir):
    """Last-day rows per zone (24 < 100 -> insufficient)."""
    g = layers.gold_grid(spark, sf_dir)
    recent = g.filter(F.col("timestamp_utc") > ev.cutoff(g, 1))
    return finish(ev.min_rows_guard(recent.groupBy("country").agg(F.count(F.lit(1)).alias("n")), minimum=100))
