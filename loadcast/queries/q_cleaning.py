"""M0-M2: scans, densify, silver cleaning, calendar and series features."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.functions import calendar as cal
from loadcast.operators import features as feat
from loadcast.operators import quality as qa
from loadcast.plans import layers
from loadcast.present import finish
from loadcast.registry import query
from loadcast.schemas import SILVER_COLUMNS
from loadcast.sources import tables
from loadcast.sources import testdata as td

W = O.with_
R = O.rnd
GRID = O.grid_ctes()
SILVER = O.silver_ctes()

# ---------------------------------------------------------------- M0

@query("scan_layer", W(("b", O.BRONZE_EVENTS)) + f"\nSELECT timestamp_utc, country, kind, {R('load_mw')} AS load_mw, ingested_at, event_id FROM b")
def scan_layer(spark, sf_dir):
    return finish(tables.scan_layer(spark, f"{sf_dir.rstrip('/')}/events.parquet", tables.EVENTS_READ_SCHEMA)
                  .transform(tables.events_as_bronze))


@query("filter_kind", W(*SILVER) + f"\nSELECT timestamp_utc, country, kind, {R('load_mw_clean')} AS load_mw_clean FROM silver WHERE kind = 'actual'")
def filter_kind(spark, sf_dir):
    s = layers.silver_grid(spark, sf_dir)
    return finish(s.filter(F.col("kind") == "actual").select("timestamp_utc", "country", "kind", "load_mw_clean"))


@query("densify_hourly", W(*GRID) + f"\nSELECT timestamp_utc, country, kind, {R('load_mw')} AS load_mw, ingested_at FROM load_grid")
def densify_hourly(spark, sf_dir):
    return finish(td.load_grid(spark, sf_dir))


@query("ffill_3", W(*SILVER) + f"\nSELECT timestamp_utc, country, {R('load_mw')} AS load_mw, {R('load_mw_clean')} AS load_mw_clean FROM silver")
def ffill_3(spark, sf_dir):
    g = td.load_grid(spark, sf_dir)
    from loadcast.plans.halo import series_window
    out = series_window(g, lambda w: {"load_mw_clean": qa.ffill("load_mw", 3)(w)}, lookback=3, bucket_steps=2016, dense=True)
    return finish(out.select("timestamp_utc", "country", "load_mw", "load_mw_clean"))


_LAGS = ", ".join(f"{R(f'load_mw_clean_lag_{k}')} AS load_mw_clean_lag_{k}" for k in (1, 24, 48, 168))


@query("lag_features", W(*SILVER, ("f", f"SELECT *, {O.lags_rolls_sql(rolls=())} FROM silver"))
       + f"\nSELECT timestamp_utc, country, {R('load_mw_clean')} AS load_mw_clean, {_LAGS} FROM f")
def lag_features(spark, sf_dir):
    s = layers.silver_grid(spark, sf_dir)
    out = feat.add_lags_rolls(s, rolls=(), bucket_steps=2016, dense=True)
    return finish(out.select("timestamp_utc", "country", "load_mw_clean",
                             *[f"load_mw_clean_lag_{k}" for k in (1, 24, 48, 168)]))


@query("cal_parts", W(*GRID) + """
SELECT timestamp_utc, country, CAST(hour(timestamp_utc) AS BIGINT) AS hour, CAST(day(timestamp_utc) AS BIGINT) AS day_of_month,
       CAST(month(timestamp_utc) AS BIGINT) AS month, CAST(quarter(timestamp_utc) AS BIGINT) AS quarter,
       CAST(year(timestamp_utc) AS BIGINT) AS year FROM load_grid""")
def cal_parts(spark, sf_dir):
    c = cal.calendar_columns("timestamp_utc")
    g = td.load_grid(spark, sf_dir)
    return finish(g.select("timestamp_utc", "country", *[c[k].alias(k) for k in
                                                         ("hour", "day_of_month", "month", "quarter", "year")]))


# ---------------------------------------------------------------- M1

@query("silver_dedup", W(("b", O.BRONZE_EVENTS)) + f"""
SELECT timestamp_utc, country, kind, {R('load_mw')} AS load_mw, ingested_at, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY timestamp_utc, country, kind ORDER BY ingested_at DESC, event_id DESC) AS rn
  FROM b) t WHERE rn = 1""")
def silver_dedup(spark, sf_dir):
    b = td.bronze_events(spark, sf_dir)
    return finish(qa.dedup_latest(b, order=[F.col("ingested_at"), F.col("event_id")]))


_FENCE_COLS = "country, " + ", ".join(f"{R(c)} AS {c}" for c in ("q1", "q3", "iqr", "lower", "upper"))


@query("iqr_fences", W(("b", O.BRONZE_EVENTS), ("f", O.fences_of("b"))) + f"\nSELECT {_FENCE_COLS} FROM f")
def iqr_fences(spark, sf_dir):
    return finish(qa.iqr_fences(td.bronze_events(spark, sf_dir), scope="zone", method="exact"))


@query("broadcast_fences", W(("b", O.BRONZE_EVENTS), ("f", O.fences_of("b", scope="global"))) + f"""
SELECT b.event_id, b.country, {R('b.load_mw')} AS load_mw, {R('f.lower')} AS lower, {R('f.upper')} AS upper,
       (b.load_mw < f.lower OR b.load_mw > f.upper) AS is_outlier
FROM b CROSS JOIN f""")
def broadcast_fences(spark, sf_dir):
    """Global fences (the reference's single quantile pair) on every row."""
    b = td.bronze_events(spark, sf_dir)
    f = qa.iqr_fences(b, scope="global", method="exact")
    out = qa.attach_fences(b, f, scope="global").withColumn("is_outlier", qa.outlier_flag())
    return finish(out.select("event_id", "country", "load_mw", "lower", "upper", "is_outlier"))


@query("outlier_flag", W(("b", O.BRONZE_EVENTS), ("f", O.fences_of("b"))) + f"""
SELECT b.event_id, b.country, {R('b.load_mw')} AS load_mw, (b.load_mw < f.lower OR b.load_mw > f.upper) AS is_outlier
FROM b LEFT JOIN f USING (country)""")
def outlier_flag(spark, sf_dir):
    b = td.bronze_events(spark, sf_dir)
    f = qa.iqr_fences(b, scope="zone", method="exact")
    out = qa.attach_fences(b, f, scope="zone").withColumn("is_outlier", qa.outlier_flag())
    return finish(out.select("event_id", "country", "load_mw", "is_outlier"))


@query("quality_flag", W(*SILVER) + f"\nSELECT timestamp_utc, country, {R('load_mw')} AS load_mw, is_outlier, quality_flag FROM silver")
def quality_flag(spark, sf_dir):
    return finish(layers.silver_grid(spark, sf_dir).select("timestamp_utc", "country", "load_mw", "is_outlier", "quality_flag"))


@query("quality_counts", W(*SILVER) + "\nSELECT country, quality_flag, count(*) AS n FROM silver GROUP BY 1, 2")
def quality_counts(spark, sf_dir):
    return finish(qa.quality_counts(layers.silver_grid(spark, sf_dir)))


_SILVER_SEL = ", ".join(R(c) + f" AS {c}" if c in ("load_mw", "load_mw_clean") else c for c in SILVER_COLUMNS)


@query("silver_projection", W(*SILVER) + f"\nSELECT {_SILVER_SEL} FROM silver")
def silver_projection(spark, sf_dir):
    return finish(layers.silver_grid(spark, sf_dir))


# ---------------------------------------------------------------- M2

@query("cal_day_of_week", W(*GRID) + "\nSELECT timestamp_utc, country, CAST(isodow(timestamp_utc) - 1 AS BIGINT) AS day_of_week FROM load_grid")
def cal_day_of_week(spark, sf_dir):
    return finish(td.load_grid(spark, sf_dir).select("timestamp_utc", "country", cal.day_of_week("timestamp_utc").alias("day_of_week")))


@query("cal_iso_week", W(("od", O.ORDERS_DAILY_RAW), ("d", O.grid_of("od", "1 DAY")))
       + "\nSELECT timestamp_utc, country, CAST(week(timestamp_utc) AS BIGINT) AS week_of_year, CAST(year(timestamp_utc) AS BIGINT) AS year FROM d")
def cal_iso_week(spark, sf_dir):
    """ISO week over 6.5 years of daily rows (crosses many year changes)."""
    c = cal.calendar_columns("timestamp_utc")
    d = td.orders_daily(spark, sf_dir)
    return finish(d.select("timestamp_utc", "country", c["week_of_year"].alias("week_of_year"), c["year"].alias("year")))


@query("cal_weekend", W(*GRID) + "\nSELECT timestamp_utc, country, CAST(isodow(timestamp_utc) >= 6 AS BIGINT) AS is_weekend FROM load_grid")
def cal_weekend(spark, sf_dir):
    c = cal.calendar_columns("timestamp_utc")
    return finish(td.load_grid(spark, sf_dir).select("timestamp_utc", "country", c["is_weekend"].alias("is_weekend")))


_CYC = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]


@query("cal_cyclic", W(*GRID, ("c", f"SELECT timestamp_utc, country, {O.calendar_sql()} FROM load_grid"),
                       ("y", f"SELECT *, {O.cyclic_sql()} FROM c"))
       + "\nSELECT timestamp_utc, country, " + ", ".join(f"{R(c)} AS {c}" for c in _CYC) + " FROM y")
def cal_cyclic(spark, sf_dir):
    out = feat.add_calendar(td.load_grid(spark, sf_dir))
    return finish(out.select("timestamp_utc", "country", *_CYC))


_ODAILY = [("od", O.ORDERS_DAILY_RAW), ("d", O.grid_of("od", "1 DAY"))]


def _orders_zone_sql():
    return O.zone_calendar_sql("country", layers.ORDERS_ZONE_MAP)


@query("cal_holiday_fixed", W(*_ODAILY) + "\nSELECT timestamp_utc, country, "
       + O.fixed_holiday_sql().replace(O.zone_calendar_sql(), _orders_zone_sql()) + " AS is_holiday FROM d")
def cal_holiday_fixed(spark, sf_dir):
    d = td.orders_daily(spark, sf_dir)
    out = feat.add_holidays(d, zone_map=layers.ORDERS_ZONE_MAP, mode="fixed")
    return finish(out.select("timestamp_utc", "country", "is_holiday"))


@query("cal_holiday_movable", W(*_ODAILY, ("hol", O.holiday_dim_sql("d"))) + "\nSELECT timestamp_utc, country, "
       + O.holiday_flag_sql().replace(O.zone_calendar_sql(), _orders_zone_sql()) + " AS is_holiday FROM d")
def cal_holiday_movable(spark, sf_dir):
    d = td.orders_daily(spark, sf_dir)
    out = feat.add_holidays(d, zone_map=layers.ORDERS_ZONE_MAP, mode="movable")
    return finish(out.select("timestamp_utc", "country", "is_holiday"))


@query("zone_to_calendar", """
SELECT zone, upper(split_part(zone, '_', 1)) AS calendar_prefix,
       CASE """ + " ".join(f"WHEN zone = '{z}' THEN '{c}'" for z, c in sorted({**layers.ORDERS_ZONE_MAP, **td.FIXTURE_ZONE_MAP}.items()))
       + """ ELSE upper(split_part(zone, '_', 1)) END AS calendar
FROM (SELECT DISTINCT event_type AS zone FROM events UNION SELECT DISTINCT o_orderpriority FROM orders) z""")
def zone_to_calendar(spark, sf_dir):
    zones = (td.table(spark, sf_dir, "events").select(F.col("event_type").alias("zone"))
             .union(td.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("zone"))).distinct())
    zmap = {**layers.ORDERS_ZONE_MAP, **td.FIXTURE_ZONE_MAP}
    return finish(zones.select("zone", cal.zone_to_calendar("zone").alias("calendar_prefix"),
                               cal.zone_to_calendar("zone", zmap).alias("calendar")))


@query("holiday_lookup", W(*_ODAILY, ("hol", O.holiday_dim_sql("d"))) + "\nSELECT calendar, CAST(holiday_date AS TIMESTAMP) AS holiday_date FROM hol")
def holiday_lookup(spark, sf_dir):
    d = td.orders_daily(spark, sf_dir)
    dim = cal.holiday_dimension(cal.years_of(d))
    return finish(dim.select("calendar", F.col("holiday_date").cast("timestamp_ntz").alias("holiday_date")))


def _roll_sel(kind):
    return ", ".join(f"{R(f'load_mw_clean_roll_{kind}_{w}')} AS load_mw_clean_roll_{kind}_{w}" for w in (24, 168))


@query("rolling_mean", W(*SILVER, ("f", f"SELECT *, {O.lags_rolls_sql(lags=())} FROM silver"))
       + f"\nSELECT timestamp_utc, country, {_roll_sel('mean')} FROM f")
def rolling_mean(spark, sf_dir):
    out = feat.add_lags_rolls(layers.silver_grid(spark, sf_dir), lags=(), bucket_steps=2016, dense=True)
    return finish(out.select("timestamp_utc", "country", "load_mw_clean_roll_mean_24", "load_mw_clean_roll_mean_168"))


@query("rolling_std", W(*SILVER, ("f", f"SELECT *, {O.lags_rolls_sql(lags=())} FROM silver"))
       + f"\nSELECT timestamp_utc, country, {_roll_sel('std')} FROM f")
def rolling_std(spark, sf_dir):
    out = feat.add_lags_rolls(layers.silver_grid(spark, sf_dir), lags=(), bucket_steps=2016, dense=True)
    return finish(out.select("timestamp_utc", "country", "load_mw_clean_roll_std_24", "load_mw_clean_roll_std_168"))


_GOLD_DOUBLES = {c for c in O.GOLD_COLUMNS if c.startswith("load_mw") or c.endswith(("_sin", "_cos"))}
GOLD_SELECT = O.select_rounded(O.GOLD_COLUMNS, _GOLD_DOUBLES)


@query("per_zone_features", W(*SILVER, *O.gold_ctes(drop=False)) + f"\nSELECT {GOLD_SELECT} FROM gold")
def per_zone_features(spark, sf_dir):
    return finish(layers.gold_grid(spark, sf_dir, drop=False).select(*O.GOLD_COLUMNS))


_LAG_JOIN = ", ".join(f"{R(f'l{k}.load_mw')} AS load_mw_clean_lag_{k}" for k in (1, 24, 48, 168))
_LAG_FROM = " ".join(f"LEFT JOIN h l{k} ON l{k}.country = h.country AND l{k}.timestamp_utc = h.timestamp_utc - INTERVAL {k} HOUR"
                     for k in (1, 24, 48, 168))


@query("lag_by_time", W(("h", O.LOAD_HOURLY)) + f"\nSELECT h.timestamp_utc, h.country, {R('h.load_mw')} AS load_mw, {_LAG_JOIN} FROM h {_LAG_FROM}")
def lag_by_time(spark, sf_dir):
    """Time-exact lags on the gappy hourly series (no densify)."""
    h = td.load_hourly(spark, sf_dir).withColumnRenamed("load_mw", "load_mw_clean")
    out = feat.lag_by_time(h, target="load_mw_clean")
    out = out.select("timestamp_utc", "country", F.col("load_mw_clean").alias("load_mw"),
                     *[f"load_mw_clean_lag_{k}" for k in (1, 24, 48, 168)])
    return finish(out)


@query("drop_incomplete_lags", W(*SILVER, *O.gold_ctes()) + f"\nSELECT {GOLD_SELECT} FROM gold")
def drop_incomplete_lags(spark, sf_dir):
    return finish(layers.gold_grid(spark, sf_dir).select(*O.GOLD_COLUMNS))


@query("gold_overwrite", W(*SILVER, *O.gold_ctes()) + f"\nSELECT {GOLD_SELECT} FROM gold")
def gold_overwrite(spark, sf_dir):
    """Write gold partitioned by country (full replace), return the table read back."""
    from loadcast.session import work_dir
    path = work_dir(spark, "gold")
    tables.overwrite_partitioned(layers.gold_grid(spark, sf_dir), path)
    return finish(tables.scan_layer(spark, path).select(*O.GOLD_COLUMNS))
