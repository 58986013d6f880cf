"""M10 composed jobs over the fixture: each run writes its layers under a
fresh folder of the shared checkpoint root and returns its output table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.functions.timecols import date_offset
from loadcast.plans import jobs, layers
from loadcast.present import finish
from loadcast.queries.q_drift import report_sql
from loadcast.queries.q_forecast import GBT_QUICK
from loadcast.queries.q_ingest import landed_pages
from loadcast.registry import query
from loadcast.schemas import SILVER_COLUMNS
from loadcast.session import work_dir
from loadcast.sources import landed, tables
from loadcast.sources import testdata as td

W = O.with_
R = O.rnd
AS_OF = "(SELECT max(timestamp_utc) FROM load_grid)"

# bronze = the non-null hours from the landed pages, stamped with the data's last hour
BRONZE = O.grid_ctes() + [("bronze", f"SELECT timestamp_utc, country, load_mw, kind, {AS_OF} AS ingested_at FROM load_grid WHERE load_mw IS NOT NULL")]
SILVER = BRONZE + [("sgrid", O.grid_zone_of("bronze")), ("fences", O.fences_of("sgrid")), ("silver", O.silver_of("sgrid", "fences"))]
GOLD = SILVER + O.gold_ctes()
_SILVER_SEL = ", ".join(f"{R(c)} AS {c}" if c in ("load_mw", "load_mw_clean") else c for c in SILVER_COLUMNS)


def _grid(spark, sf_dir):
    """The hourly grid, written once: pages and time bounds follow from it, and
    the bounds are read again wherever a batch is used."""
    return layers.materialize(td.load_grid(spark, sf_dir), "grid")


def _readers(spark, sf_dir, grid):
    return {"eia": lambda: landed.pages_to_series(landed.scan_json_pages(spark, landed_pages(spark, sf_dir, grid), with_request=True))}


def _as_of(grid):
    return grid.select(F.max("timestamp_utc")).scalar()


def _run(spark, sf_dir, upto: str):
    """Two batches, each taken through all layers: the first 20 days, then what
    starts at day 15 (five days again, the rest new)."""
    root = work_dir(spark, "jobs")
    p = {k: os.path.join(root, k) for k in ("bronze", "silver", "gold", "models", "ledger", "drift", "dashboard")}
    grid = _grid(spark, sf_dir)
    series = _readers(spark, sf_dir, grid)["eia"]()
    lo = grid.select(F.min("timestamp_utc")).scalar()
    for part in (F.col("timestamp_utc") < date_offset(lo, days=20), F.col("timestamp_utc") >= date_offset(lo, days=15)):
        jobs.job_bronze(spark, {"eia": lambda part=part: series.filter(part)}, "eia", p["bronze"], _as_of(grid))
        if upto != "bronze":
            jobs.job_silver(spark, p["bronze"], p["silver"], fence_method="exact")
        if upto == "gold":
            jobs.job_gold(spark, p["silver"], p["gold"], td.FIXTURE_ZONE_MAP)
    return p


_LAYERS: dict[tuple[str, str], dict[str, str]] = {}


def _layers(spark, sf_dir):
    """The layers up to gold, built once per application and data folder for
    the jobs that start from gold; what these write gets a folder of its own."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _LAYERS:
        _LAYERS[key] = _run(spark, sf_dir, "gold")
    own = work_dir(spark, "jobs")
    return _LAYERS[key] | {k: os.path.join(own, k) for k in ("models", "ledger", "drift", "dashboard")}


@query("job_bronze", W(*BRONZE) + f"\nSELECT timestamp_utc, country, {R('load_mw')} AS load_mw, kind, ingested_at FROM bronze")
def job_bronze(spark, sf_dir):
    p = _run(spark, sf_dir, "bronze")
    return finish(tables.scan_layer(spark, p["bronze"]).select("timestamp_utc", "country", "load_mw", "kind", "ingested_at"))


@query("job_silver", W(*SILVER) + f"\nSELECT {_SILVER_SEL} FROM silver")
def job_silver(spark, sf_dir):
    p = _run(spark, sf_dir, "silver")
    return finish(tables.scan_layer(spark, p["silver"]).select(*SILVER_COLUMNS))


@query("job_gold", W(*GOLD) + f"\nSELECT {O.select_rounded(O.GOLD_COLUMNS, {c for c in O.GOLD_COLUMNS if c.startswith('load_mw') or c.endswith(('_sin', '_cos'))})} FROM gold")
def job_gold(spark, sf_dir):
    p = _run(spark, sf_dir, "gold")
    return finish(tables.scan_layer(spark, p["gold"]).select(*O.GOLD_COLUMNS))


@query("job_train")
def job_train(spark, sf_dir):
    """Candidates on the job's gold table (7-day holdout), champion, forest, ledger."""
    p = _layers(spark, sf_dir)
    m = jobs.job_train(spark, p["gold"], p["models"], p["ledger"], test_days=7, gbt_params=GBT_QUICK,
                       seq_len=168, n_trees=200)
    return finish(m.select("model", "status", "mape", "rmse", "mae", "is_champion"))


@query("job_drift", report_sql(GOLD))
def job_drift(spark, sf_dir):
    p = _layers(spark, sf_dir)
    return finish(jobs.job_drift(spark, p["gold"], p["drift"], ref_days=60, cur_days=7))


@query("job_dashboard_tables", W(*GOLD) + f"""
SELECT country, count(*) AS records, {R('avg(load_mw_clean)')} AS avg_load, {R('max(load_mw_clean)')} AS peak_load,
       strftime(min(timestamp_utc), '%Y-%m-%d') AS first_date, strftime(max(timestamp_utc), '%Y-%m-%d') AS last_date
FROM gold GROUP BY country""")
def job_dashboard_tables(spark, sf_dir):
    p = _layers(spark, sf_dir)
    return finish(jobs.job_dashboard_tables(spark, p["gold"], p["dashboard"]))


def _dashboard(spark, sf_dir, name):
    p = _layers(spark, sf_dir)
    jobs.job_dashboard_tables(spark, p["gold"], p["dashboard"])
    return finish(spark.read.parquet(os.path.join(p["dashboard"], name)))


@query("job_dashboard_recent", W(*GOLD) + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS load_mw_clean, {R('load_mw_clean_roll_mean_168')} AS load_mw_clean_roll_mean_168
FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY timestamp_utc DESC) AS rn FROM gold) t WHERE rn <= 720""")
def job_dashboard_recent(spark, sf_dir):
    return _dashboard(spark, sf_dir, "last_30_days")


@query("job_dashboard_profile", W(*GOLD) + f"""
SELECT country, hour, {R('quantile_cont(load_mw_clean, 0.5)')} AS median, {R('quantile_cont(load_mw_clean, 0.25)')} AS q25,
       {R('quantile_cont(load_mw_clean, 0.75)')} AS q75 FROM gold GROUP BY country, hour""")
def job_dashboard_profile(spark, sf_dir):
    return _dashboard(spark, sf_dir, "hourly_profile")


@query("job_full", W(*GOLD) + """
SELECT 'bronze' AS layer, count(*) AS rows FROM bronze UNION ALL SELECT 'bronze_rejects', 0
UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM gold
UNION ALL SELECT 'models', 5 UNION ALL SELECT 'drift', 1
UNION ALL SELECT 'dashboard', count(DISTINCT country) FROM gold""")
def job_full(spark, sf_dir):
    """All stages in order; one row per layer with its row count."""
    root, grid = work_dir(spark, "job_full"), _grid(spark, sf_dir)
    return finish(jobs.job_full(spark, root, _readers(spark, sf_dir, grid), "eia", _as_of(grid),
                                zone_map=td.FIXTURE_ZONE_MAP, fence_method="exact",
                                train_kwargs={"test_days": 7, "gbt_params": GBT_QUICK, "seq_len": 168, "n_trees": 200},
                                drift_kwargs={"ref_days": 60, "cur_days": 7}))
