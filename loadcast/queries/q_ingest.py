"""M4 ingestion: landed pages, typed bronze, snapshot upserts, logs, resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.functions.calendar import KNOWN_US_ZONES
from loadcast.functions.timecols import date_offset, hour_floor, parse_utc
from loadcast.operators import quality as qa
from loadcast.plans import layers
from loadcast.plans.halo import series_window
from loadcast.present import finish
from loadcast.registry import query
from loadcast.session import work_dir
from loadcast.sources import landed, tables
from loadcast.sources import testdata as td

W = O.with_
R = O.rnd
GRID = O.grid_ctes()
PAGE_DAYS = 7
SPAN = PAGE_DAYS * 86400


def landed_pages(spark, sf_dir, grid=None):
    """Pages for the fixture: the hourly grid (written once: its extent and its
    rows are read) landed in 7-day windows."""
    path = work_dir(spark, "landed")
    if grid is None:
        grid = layers.materialize(td.load_grid(spark, sf_dir), "grid")
    return landed.write_landed_pages(grid, path, days=PAGE_DAYS)


PAGE_ROWS = GRID + [
    ("pb", "SELECT min(timestamp_utc) AS lo, max(timestamp_utc) AS hi FROM load_grid"),
    ("pr", f"""SELECT g.*, date_diff('second', pb.lo, g.timestamp_utc) AS secs, pb.lo, pb.hi,
       greatest(ceil(date_diff('second', pb.lo, pb.hi) / {float(SPAN)}), 1) AS nwin FROM load_grid g, pb"""),
    ("pk", f"""SELECT *, least(floor(secs / {SPAN}), nwin - 1) AS k0,
       (secs % {SPAN} = 0 AND secs > 0 AND floor(secs / {SPAN}) <= nwin - 1) AS edge FROM pr"""),
    ("pages", "SELECT *, k0 AS k FROM pk UNION ALL SELECT *, k0 - 1 AS k FROM pk WHERE edge"),
]


@query("scan_json_pages", W(*PAGE_ROWS) + f"\nSELECT timestamp_utc, country, {R('load_mw')} AS load_mw FROM pages WHERE load_mw IS NOT NULL")
def scan_json_pages(spark, sf_dir):
    return finish(landed.scan_json_pages(spark, landed_pages(spark, sf_dir)))


@query("scan_json_pages_keep_nulls", W(*PAGE_ROWS) + f"\nSELECT timestamp_utc, country, {R('load_mw')} AS load_mw FROM pages")
def scan_json_pages_keep_nulls(spark, sf_dir):
    return finish(landed.scan_json_pages(spark, landed_pages(spark, sf_dir), keep_nulls=True))


@query("json_extract", W(*PAGE_ROWS) + f"""
SELECT country AS respondent, strftime(min(lo) + to_days(CAST(k * {PAGE_DAYS} AS INTEGER)), '%Y-%m-%dT%H') AS window_start,
       strftime(least(min(lo) + to_days(CAST((k + 1) * {PAGE_DAYS} AS INTEGER)), min(hi)), '%Y-%m-%dT%H') AS window_end,
       count(*) AS n_rows, 'ok' AS status
FROM pages GROUP BY country, k""")
def json_extract(spark, sf_dir):
    return finish(landed.page_summary(spark, landed_pages(spark, sf_dir)))


_OFFSETS = ["+00:00", "+02:00", "-05:00"]
_OFF_HOURS = [0, 2, -5]


@query("parse_utc", f"""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 3 {' '.join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(_OFFSETS))} END AS raw,
       CAST(date_trunc('second', ts) AS TIMESTAMP) - to_hours(CASE event_id % 3 {' '.join(f'WHEN {i} THEN {h}' for i, h in enumerate(_OFF_HOURS))} END) AS timestamp_utc
FROM events""")
def parse_utc_q(spark, sf_dir):
    """Offset-carrying local strings (offset picked per event) -> UTC."""
    ev = td.table(spark, sf_dir, "events")
    off = F.element_at(F.array(*[F.lit(o) for o in _OFFSETS]), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), off)
    return finish(ev.select("event_id", raw.alias("raw")).withColumn("timestamp_utc", parse_utc("raw")))


@query("plan_fetch_windows", W(("h", O.LOAD_HOURLY), ("b", "SELECT country, min(timestamp_utc) AS lo, max(timestamp_utc) AS hi FROM h GROUP BY country"),
                               ("s", "SELECT country, lo, hi, unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS window_start FROM b")) + """
SELECT country, window_start, least(window_start + INTERVAL 7 DAY, hi) AS window_end FROM s WHERE window_start < hi""")
def plan_fetch_windows(spark, sf_dir):
    """Fetch windows of 7 days over each zone's [first, last] hour."""
    h = td.load_hourly(spark, sf_dir)
    b = h.groupBy("country").agg(F.min("timestamp_utc").alias("lo"), F.max("timestamp_utc").alias("hi"))
    w = b.select("country", F.explode(landed.plan_fetch_windows(F.col("lo"), F.col("hi"), PAGE_DAYS)).alias("w"))
    return finish(w.select("country", "w.window_start", "w.window_end"))


@query("date_offset", W(*GRID) + """
SELECT country, max(timestamp_utc) AS max_ts, max(timestamp_utc) - INTERVAL 7 DAY AS minus_7d,
       max(timestamp_utc) + INTERVAL 1 DAY + INTERVAL 6 HOUR AS plus_1d6h FROM load_grid GROUP BY country""")
def date_offset_q(spark, sf_dir):
    g = td.load_grid(spark, sf_dir).groupBy("country").agg(F.max("timestamp_utc").alias("max_ts"))
    return finish(g.select("country", "max_ts", date_offset("max_ts", days=-7).alias("minus_7d"),
                           date_offset("max_ts", days=1, hours=6).alias("plus_1d6h")))


_SERIES_SQL = W(*GRID) + f"\nSELECT timestamp_utc, country, {R('load_mw')} AS load_mw, 'actual' AS kind FROM load_grid WHERE load_mw IS NOT NULL"


@query("pages_to_series", _SERIES_SQL)
def pages_to_series(spark, sf_dir):
    rows = landed.scan_json_pages(spark, landed_pages(spark, sf_dir), with_request=True)
    return finish(landed.pages_to_series(rows, "actual"))


@query("known_zone_check", "SELECT DISTINCT event_type AS country FROM events WHERE event_type NOT IN ("
       + ", ".join(repr(z) for z in KNOWN_US_ZONES) + ")")
def known_zone_check(spark, sf_dir):
    known = spark.createDataFrame([(z,) for z in KNOWN_US_ZONES], "zone string")
    zones = td.table(spark, sf_dir, "events").select(F.col("event_type").alias("country"))
    return finish(landed.known_zone_check(zones, known))


_WIDE_SQL = W(("h", O.LOAD_HOURLY)) + """
SELECT t.timestamp_utc, z.country AS source, h.load_mw AS generation_mw
FROM (SELECT DISTINCT timestamp_utc FROM h) t CROSS JOIN (VALUES """ + ", ".join(f"('{z}')" for z in td.FIXTURE_ZONES) + """) z(country)
LEFT JOIN h ON h.timestamp_utc = t.timestamp_utc AND h.country = z.country"""


@query("scan_load_series", W(("h", O.LOAD_HOURLY)) + f"""
SELECT t.timestamp_utc, 'click' AS country, {R('h.load_mw')} AS load_mw, 'actual' AS kind
FROM (SELECT DISTINCT timestamp_utc FROM h) t LEFT JOIN h ON h.timestamp_utc = t.timestamp_utc AND h.country = 'click'""")
def scan_load_series(spark, sf_dir):
    wide = td.generation_wide(spark, sf_dir).drop("country")
    return finish(landed.scan_load_series(wide, "timestamp_utc", zone="click"))


@query("source_dispatch", _SERIES_SQL)
def source_dispatch(spark, sf_dir):
    readers = {
        "eia": lambda: landed.pages_to_series(landed.scan_json_pages(spark, landed_pages(spark, sf_dir), with_request=True)),
        "entsoe": lambda: landed.scan_load_series(td.generation_wide(spark, sf_dir).drop("country"), "timestamp_utc", "click"),
    }
    return finish(landed.source_dispatch(readers, "eia"))


@query("unpivot_generation", f"SELECT timestamp_utc, 'ALL' AS country, source, {R('generation_mw')} AS generation_mw FROM ("
       + _WIDE_SQL + ") u")
def unpivot_generation(spark, sf_dir):
    return finish(landed.unpivot_generation(td.generation_wide(spark, sf_dir)))


def _window_sql(days):
    return W(("b", O.BRONZE_EVENTS)) + f"""
SELECT event_id, timestamp_utc, country, {R('load_mw')} AS load_mw FROM b
WHERE timestamp_utc BETWEEN (SELECT max(timestamp_utc) FROM b) - INTERVAL {days} DAY AND (SELECT max(timestamp_utc) FROM b)"""


def _window_q(spark, sf_dir, days):
    ev = td.table(spark, sf_dir, "events")
    newest = ev.agg(F.max(hour_floor("ts"))).first()[0]  # one value, fetched as a literal
    rows = tables.events_as_bronze(landed.ingest_window(ev, newest, days))
    return finish(rows.select("event_id", "timestamp_utc", "country", "load_mw"))


@query("ingest_window", _window_sql(7))
def ingest_window(spark, sf_dir):
    return _window_q(spark, sf_dir, 7)


@query("ingest_backfill", _window_sql(30))
def ingest_backfill(spark, sf_dir):
    return _window_q(spark, sf_dir, 30)


_BRONZE_SQL = W(("b", O.BRONZE_EVENTS)) + f"\nSELECT timestamp_utc, country, {R('load_mw')} AS load_mw, kind, ingested_at FROM b"


def _typed(spark, sf_dir):
    return tables.bronze_typed(td.bronze_events(spark, sf_dir))


@query("bronze_typed", _BRONZE_SQL)
def bronze_typed(spark, sf_dir):
    return finish(_typed(spark, sf_dir))


@query("bronze_create", _BRONZE_SQL)
def bronze_create(spark, sf_dir):
    path = tables.create_table(_typed(spark, sf_dir), work_dir(spark, "bronze"))
    return finish(tables.scan_layer(spark, path).select("timestamp_utc", "country", "load_mw", "kind", "ingested_at"))


_LO = "(SELECT min(timestamp_utc) FROM load_hourly)"


@query("bronze_upsert", W(("b", O.BRONZE_EVENTS), ("load_hourly", O.LOAD_HOURLY),
                          ("first", f"""SELECT timestamp_utc, country, kind, load_mw, ingested_at FROM (
  SELECT *, row_number() OVER (PARTITION BY timestamp_utc, country, kind ORDER BY ingested_at DESC, event_id DESC) AS rn FROM b) t
  WHERE rn = 1 AND timestamp_utc < {_LO} + INTERVAL 20 DAY"""),
                          ("batch", f"SELECT timestamp_utc, country, kind, load_mw, ingested_at FROM load_hourly WHERE timestamp_utc >= {_LO} + INTERVAL 15 DAY"))
       + f"""
SELECT timestamp_utc, country, kind, {R('load_mw')} AS load_mw, ingested_at FROM (
  SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM batch s WHERE s.timestamp_utc = f.timestamp_utc AND s.country = f.country AND s.kind = f.kind)
  UNION ALL SELECT * FROM batch) u""")
def bronze_upsert(spark, sf_dir):
    """Table = latest event per hour for the first 20 days; then the hourly
    sums from day 15 on arrive as a restatement and replace/insert by key."""
    cols = ["timestamp_utc", "country", "kind", "load_mw", "ingested_at"]
    hourly = td.load_hourly(spark, sf_dir)
    lo = hourly.select(F.min("timestamp_utc")).scalar()
    first = qa.dedup_latest(td.bronze_events(spark, sf_dir), order=[F.col("ingested_at"), F.col("event_id")])
    first = first.filter(F.col("timestamp_utc") < date_offset(lo, days=20)).select(*cols)
    batch = hourly.filter(F.col("timestamp_utc") >= date_offset(lo, days=15)).select(*cols)
    path = work_dir(spark, "bronze_upsert")
    tables.create_table(first, path)
    tables.upsert(spark, batch, path)
    return finish(tables.scan_layer(spark, path).select(*cols))


_SILVER_SEL = ", ".join(f"{R(c)} AS {c}" if c in ("load_mw", "load_mw_clean") else c for c in
                        ["timestamp_utc", "country", "kind", "load_mw", "load_mw_clean", "is_outlier", "quality_flag", "ingested_at"])


@query("silver_upsert", W(*O.silver_ctes()) + f"\nSELECT {_SILVER_SEL} FROM silver")
def silver_upsert(spark, sf_dir):
    """Silver for the first 20 days, then the full recomputed silver merged in."""
    s = layers.silver_grid(spark, sf_dir)
    lo = s.select(F.min("timestamp_utc")).scalar()
    path = work_dir(spark, "silver_upsert")
    tables.create_table(s.filter(F.col("timestamp_utc") < date_offset(lo, days=20)), path)
    tables.upsert(spark, s, path)
    return finish(tables.scan_layer(spark, path).select(*s.columns))


@query("write_audit_count", "SELECT count(*) AS rows_written FROM events")
def write_audit_count(spark, sf_dir):
    _, n = tables.write_counted(_typed(spark, sf_dir), work_dir(spark, "audit"))
    return spark.createDataFrame([(n,)], "rows_written bigint")


_LOG_SQL = W(("b", O.BRONZE_EVENTS)) + f"\nSELECT timestamp_utc, country, kind, {R('load_mw')} AS load_mw, ingested_at, event_id FROM b"


def _log(spark, sf_dir):
    b = td.bronze_events(spark, sf_dir)
    lo = b.select(F.min("timestamp_utc")).scalar()
    path = work_dir(spark, "bronze_log")
    tables.append_log(b.filter(F.col("timestamp_utc") < date_offset(lo, days=15)), path)
    tables.append_log(b.filter(F.col("timestamp_utc") >= date_offset(lo, days=15)), path)
    return tables.scan_layer(spark, path).select(*b.columns)


@query("bronze_append_log", _LOG_SQL)
def bronze_append_log(spark, sf_dir):
    return finish(_log(spark, sf_dir))


@query("bronze_as_of", W(("b", O.BRONZE_EVENTS)) + f"""
SELECT timestamp_utc, country, kind, {R('load_mw')} AS load_mw, ingested_at, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY timestamp_utc, country, kind ORDER BY ingested_at DESC, event_id DESC) AS rn
  FROM b WHERE ingested_at <= (SELECT min(timestamp_utc) FROM b) + INTERVAL 10 DAY) t WHERE rn = 1""")
def bronze_as_of(spark, sf_dir):
    """The table as it was 10 days after the first hour: log filtered on
    ingested_at, then latest per key."""
    log = _log(spark, sf_dir)
    t = date_offset(log.select(F.min("timestamp_utc")).scalar(), days=10)
    return finish(qa.dedup_latest(log.filter(F.col("ingested_at") <= t), order=[F.col("ingested_at"), F.col("event_id")]))


@query("resample_hourly", f"""
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp_utc, event_type AS country, {R('avg(value)')} AS load_mw, count(*) AS n
FROM events GROUP BY 1, 2""")
def resample_hourly(spark, sf_dir):
    ev = td.table(spark, sf_dir, "events")
    return finish(ev.groupBy(hour_floor("ts").alias("timestamp_utc"), F.col("event_type").alias("country"))
                  .agg(F.avg("value").alias("load_mw"), F.count(F.lit(1)).alias("n")))


@query("weather_join", W(*O.silver_ctes(),
                         ("exo", "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp_utc, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS exo FROM events GROUP BY 1"),
                         ("j", "SELECT s.timestamp_utc, s.country, s.kind, s.load_mw_clean, e.exo FROM silver s LEFT JOIN exo e USING (timestamp_utc)"))
       + f"""
SELECT timestamp_utc, country, {R('load_mw_clean')} AS load_mw_clean, {R('exo')} AS exo_raw,
       {R('last_value(exo IGNORE NULLS) OVER (PARTITION BY country, kind ORDER BY timestamp_utc ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)')} AS exo_asof
FROM j""")
def weather_join(spark, sf_dir):
    """Exogenous hourly signal (mean of the events' JSON ``k``) joined by hour,
    then as-of filled from at most 24 hours back."""
    ev = td.table(spark, sf_dir, "events")
    exo = ev.groupBy(hour_floor("ts").alias("timestamp_utc")).agg(
        F.avg(F.get_json_object("props", "$.k").cast("double")).alias("exo"))
    s = layers.silver_grid(spark, sf_dir).join(exo, "timestamp_utc", "left")
    out = series_window(s, lambda w: {"exo_asof": F.last("exo", ignorenulls=True).over(w.rowsBetween(-24, 0))},
                        lookback=24, bucket_steps=2016, dense=True)
    return finish(out.select("timestamp_utc", "country", "load_mw_clean", F.col("exo").alias("exo_raw"), "exo_asof"))
