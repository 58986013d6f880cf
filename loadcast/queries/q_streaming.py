"""M9 streaming: drained availableNow runs over landed files; outputs read back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from loadcast import oracle_sql as O
from loadcast.functions.timecols import date_offset
from loadcast.operators import forecast as fc
from loadcast.operators.features import add_calendar, add_holidays
from loadcast.present import finish
from loadcast.queries.q_forecast import GBT_QUICK, split
from loadcast.registry import query
from loadcast.session import work_dir
from loadcast.sources import tables
from loadcast.sources import testdata as td
from loadcast.streaming import streams as st

W = O.with_
R = O.rnd
DELAY_H = 1


def _events_stream(spark, sf_dir):
    td.table(spark, sf_dir, "events")  # pins the session zone
    return st.file_stream(spark, sf_dir, st.EVENTS_SCHEMA, glob="events.parquet")


def _land(df, folder, name=None):
    """Land files into ``folder`` (appending, as an upstream writer would)."""
    path = os.path.join(folder, name) if name else folder
    df.write.mode("append").parquet(path)
    return path


@query("stream_upsert", W(("b", O.BRONZE_EVENTS)) + f"""
SELECT timestamp_utc, country, kind, {R('load_mw')} AS load_mw, ingested_at, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY timestamp_utc, country, kind ORDER BY ingested_at DESC, event_id DESC) AS rn FROM b) t
WHERE rn = 1""")
def stream_upsert(spark, sf_dir):
    d = work_dir(spark, "stream_upsert")
    table = os.path.join(d, "table")
    st.stream_upsert(st.as_bronze(_events_stream(spark, sf_dir)), table, os.path.join(d, "ckpt"))
    return finish(tables.scan_layer(spark, table).select("timestamp_utc", "country", "kind", "load_mw", "ingested_at", "event_id"))


@query("stream_dedup", """
SELECT DISTINCT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp_utc, event_type AS country, 'actual' AS kind FROM events""")
def stream_dedup(spark, sf_dir):
    """First arrival per (hour, zone) within a 3-hour watermark."""
    d = work_dir(spark, "stream_dedup")
    st.stream_dedup(st.as_bronze(_events_stream(spark, sf_dir)), os.path.join(d, "out"), os.path.join(d, "ckpt"))
    return finish(spark.read.parquet(os.path.join(d, "out")).select("timestamp_utc", "country", "kind"))


def _closed_hourly_sql(extra_where="TRUE"):
    return f"""SELECT window_start, window_end, country, {R('sum(value)')} AS load_sum, {R('avg(value)')} AS load_avg, count(*) AS n FROM (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end,
         event_type AS country, value FROM events WHERE {extra_where}) e
WHERE window_end <= (SELECT max(ts) FROM events WHERE {extra_where}) - INTERVAL {DELAY_H} HOUR
GROUP BY 1, 2, 3"""


@query("stream_hourly", _closed_hourly_sql())
def stream_hourly(spark, sf_dir):
    """Hourly windows per zone, watermark 1 hour; closed windows only."""
    d = work_dir(spark, "stream_hourly")
    st.stream_to_parquet(st.windowed_load(_events_stream(spark, sf_dir), delay=f"{DELAY_H} hour"),
                         os.path.join(d, "out"), os.path.join(d, "ckpt"))
    return finish(spark.read.parquet(os.path.join(d, "out")))


@query("stream_rolling", f"""
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, country, {R('sum(value)')} AS load_sum, {R('avg(value)')} AS load_avg, count(*) AS n
FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) - to_hours(CAST(k AS INTEGER)) AS window_start, event_type AS country, value
      FROM events, range(0, 24) r(k)) e
WHERE window_start + INTERVAL 24 HOUR <= (SELECT max(ts) FROM events) - INTERVAL {DELAY_H} HOUR
GROUP BY 1, 2, 3""")
def stream_rolling(spark, sf_dir):
    """24-hour windows sliding by 1 hour per zone; closed windows only."""
    d = work_dir(spark, "stream_rolling")
    st.stream_to_parquet(st.windowed_load(_events_stream(spark, sf_dir), "24 hours", "1 hour", f"{DELAY_H} hour"),
                         os.path.join(d, "out"), os.path.join(d, "ckpt"))
    return finish(spark.read.parquet(os.path.join(d, "out")))


_LO = "(SELECT min(ts) FROM events)"


@query("stream_late", _closed_hourly_sql(f"ts >= {_LO} + INTERVAL 15 DAY"))
def stream_late(spark, sf_dir):
    """The last 15 days land first, the first 15 days land afterwards: the
    second run's rows are behind the watermark and are dropped."""
    d = work_dir(spark, "stream_late")
    ev = td.table(spark, sf_dir, "events")
    cut = date_offset(ev.select(F.min("ts")).scalar(), days=15)
    land = os.path.join(d, "land")
    out, ckpt = os.path.join(d, "out"), os.path.join(d, "ckpt")

    def run():
        s = st.file_stream(spark, land, st.EVENTS_SCHEMA)
        st.stream_to_parquet(st.windowed_load(s, delay=f"{DELAY_H} hour"), out, ckpt)

    _land(ev.filter(F.col("ts") >= cut), land)
    run()
    _land(ev.filter(F.col("ts") < cut), land)
    run()
    return finish(spark.read.parquet(out))


@query("stream_schema_evolution", f"""
SELECT event_id, {R('value')} AS value, CASE WHEN ts >= {_LO} + INTERVAL 15 DAY THEN props END AS props FROM events""")
def stream_schema_evolution(spark, sf_dir):
    """Files without ``props`` land first; files with it later.  The stream
    restarts with the wider schema; the sink is read with mergeSchema."""
    d = work_dir(spark, "stream_schema")
    ev = td.table(spark, sf_dir, "events")
    cut = date_offset(ev.select(F.min("ts")).scalar(), days=15)
    land, out, ckpt = os.path.join(d, "land"), os.path.join(d, "out"), os.path.join(d, "ckpt")
    v1 = ev.filter(F.col("ts") < cut).select("event_id", "ts", "event_type", "value")
    _land(v1, land)
    s1 = st.file_stream(spark, land, v1.schema)
    st.stream_to_parquet(s1, out, ckpt)
    _land(ev.filter(F.col("ts") >= cut).select("event_id", "ts", "event_type", "value", "props"), land)
    from pyspark.sql import types as T
    v2 = T.StructType([*v1.schema.fields, T.StructField("props", T.StringType())])
    s2 = st.file_stream(spark, land, v2)
    st.stream_to_parquet(s2, out, ckpt)
    return finish(spark.read.option("mergeSchema", True).parquet(out).select("event_id", "value", "props"))


@query("stream_score")
def stream_score(spark, sf_dir):
    """Raw hours land as files after the training cutoff; the stream's state,
    warmed up with the hours before it, makes their features, and each
    micro-batch is scored by the trained pipeline."""
    d = work_dir(spark, "stream_score")
    train, test = split(spark, sf_dir)
    model = fc.fit_gbt(train, **GBT_QUICK)
    cutoff = test.select(F.min("timestamp_utc")).scalar()
    hourly = td.load_hourly(spark, sf_dir)
    land, out, ckpt = (os.path.join(d, x) for x in ("land", "out", "ckpt"))

    def score(rows):
        gold = add_holidays(add_calendar(rows), zone_map=td.FIXTURE_ZONE_MAP).withColumn("y", F.col("load_mw_clean"))
        return fc.predict(model, gold).select("timestamp_utc", "country", "y", "prediction")

    def run():
        st.stream_score(st.stream_features(st.file_stream(spark, land, hourly.schema)), score, out, ckpt)

    _land(hourly.filter(F.col("timestamp_utc") < cutoff), land)
    run()
    _land(hourly.filter(F.col("timestamp_utc") >= cutoff), land)
    run()
    return finish(spark.read.parquet(out).filter(F.col("timestamp_utc") >= cutoff).select("timestamp_utc", "country", "y", "prediction"))


@query("stream_corrections", f"""
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type AS country, {R('sum(value)')} AS load_sum,
       {R('avg(value)')} AS load_avg, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_corrections(spark, sf_dir):
    """The last 15 days land first, the others after them, all late: their
    windows are emitted again, and the table is that of all rows."""
    d = work_dir(spark, "stream_corrections")
    ev = td.table(spark, sf_dir, "events")
    cut = date_offset(ev.select(F.min("ts")).scalar(), days=15)
    land, table = os.path.join(d, "land"), os.path.join(d, "table")

    def run():
        st.correct_windows(st.file_stream(spark, land, st.EVENTS_SCHEMA), table, os.path.join(d, "late"), os.path.join(d, "ckpt"))

    _land(ev.filter(F.col("ts") >= cut), land)
    run()
    _land(ev.filter(F.col("ts") < cut), land)
    run()
    return finish(tables.scan_layer(spark, table).select("window_start", "country", "load_sum", "load_avg", "n"))


STREAM_COLUMNS = [f.split()[0] for f in st.FEATURES.split(", ") if not f.startswith(("late", "kind"))]


@query("stream_features", W(("load_hourly", O.LOAD_HOURLY), ("sgrid", O.grid_zone_of("load_hourly")),
                            ("clean", f"""SELECT *, coalesce(load_mw, last_value(load_mw IGNORE NULLS) OVER (PARTITION BY country, kind
  ORDER BY timestamp_utc ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) AS load_mw_clean FROM sgrid"""),
                            ("feat", f"SELECT *, {O.lags_rolls_sql()} FROM clean"))
       + f"\nSELECT {O.select_rounded(STREAM_COLUMNS)} FROM feat")
def stream_features(spark, sf_dir):
    """Hours arrive in three runs of the stream, which restarts from its
    checkpoint; the state carries fills, lags and rolls across."""
    d = work_dir(spark, "stream_features")
    hourly = td.load_hourly(spark, sf_dir)
    lo = hourly.select(F.min("timestamp_utc")).scalar()
    land, out, ckpt = os.path.join(d, "land"), os.path.join(d, "out"), os.path.join(d, "ckpt")
    for a, z in ((0, 10), (10, 11), (11, 100_000)):
        _land(hourly.filter((F.col("timestamp_utc") >= date_offset(lo, days=a)) & (F.col("timestamp_utc") < date_offset(lo, days=z))), land)
        st.stream_to_parquet(st.stream_features(st.file_stream(spark, land, hourly.schema)), out, ckpt)
    return finish(spark.read.parquet(out).select(*STREAM_COLUMNS))
