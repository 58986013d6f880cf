from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001
from loadcast.session import work_dir
from loadcast.sources import tables
from loadcast.streaming import streams as st


def test_stream_upsert_restart_is_idempotent(spark):
    d = work_dir(spark, "t_stream")
    table, ckpt = os.path.join(d, "t"), os.path.join(d, "c")
    src = lambda: st.as_bronze(st.file_stream(spark, SF001, st.EVENTS_SCHEMA, glob="events.parquet"))
    st.stream_upsert(src(), table, ckpt)
    first = sorted(tables.scan_layer(spark, table).collect())
    st.stream_upsert(src(), table, ckpt)  # restart: nothing new to read
    assert sorted(tables.scan_layer(spark, table).collect()) == first


def test_stream_hourly_equals_batch_on_closed_windows(spark):
    d = work_dir(spark, "t_hourly")
    s = st.file_stream(spark, SF001, st.EVENTS_SCHEMA, glob="events.parquet")
    st.stream_to_parquet(st.windowed_load(s), os.path.join(d, "o"), os.path.join(d, "c"))
    got = spark.read.parquet(os.path.join(d, "o"))
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    mx = ev.agg(F.max("ts")).first()[0]
    batch = (ev.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"),
                        F.col("event_type").alias("country")).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("window_start") + F.expr("INTERVAL 2 HOUR") <= F.lit(mx)))
    assert sorted(got.select("window_start", "country", "n").collect()) == sorted(batch.collect())


def _hours(spark, values, start=0):
    import datetime as dt
    t0 = dt.datetime(2023, 5, 1)
    rows = [(t0 + dt.timedelta(hours=h), z, "actual", v, t0 + dt.timedelta(hours=h, minutes=i)) for i, (h, z, v) in enumerate(values)]
    return spark.createDataFrame(rows, "timestamp_utc timestamp_ntz, country string, kind string, load_mw double, ingested_at timestamp_ntz")


def test_stream_features_equal_batch_across_restarts_and_flag_late_rows(spark):
    from loadcast.operators import quality as qa
    from loadcast.operators.features import add_lags_rolls
    d = work_dir(spark, "t_features")
    land, out, ckpt = (os.path.join(d, x) for x in ("land", "out", "ckpt"))
    value = lambda z, h: None if h % 31 == 4 else 100.0 + (h * 7919 % 113) + 50 * (z == "B")
    hours = [h for h in range(430) if not 200 < h < 209 and h % 17 != 3]
    batches = [[(h, z, value(z, h)) for h in hours if a <= h < b for z in "AB"] for a, b in ((0, 150), (150, 151), (151, 430))]
    batches[1].append((150, "A", 999.0))               # the hour again, later: it counts
    batches[2] += [(100, "A", 5.0), (3, "B", 7.0)]     # behind the newest hour: late
    for rows in batches:
        _hours(spark, rows).write.mode("append").parquet(land)
        st.stream_to_parquet(st.stream_features(st.file_stream(spark, land, spark.read.parquet(land).schema)), out, ckpt)
    got = spark.read.parquet(out)
    assert sorted((r["country"], r["load_mw"]) for r in got.filter("late").collect()) == [("A", 5.0), ("B", 7.0)]
    series = qa.dedup_latest(_hours(spark, [x for rows in batches for x in rows if x[2] not in (5.0, 7.0)]))
    batch = add_lags_rolls(qa.series_window(qa.densify(series, bounds="zone"), lambda w: {"load_mw_clean": qa.ffill()(w)}))
    cols = [c for c in got.columns if c != "late"]
    rows = lambda df: sorted(map(repr, df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.select(*cols).dtypes]).collect()))
    assert rows(got.filter("not late")) == rows(batch)


def test_late_rows_correct_their_windows(spark):
    import datetime as dt
    d = work_dir(spark, "t_late")
    land, table, late, ckpt = (os.path.join(d, x) for x in ("land", "table", "late", "ckpt"))
    t0 = dt.datetime(2023, 4, 30, 20)
    batches = [[(1, 0, 5.0), (2, 30, 7.0), (3, 400, 1.0)], [(4, 20, 11.0), (5, 390, 2.0), (6, 460, 3.0)], [(7, 10, None), (8, 459, 4.0)]]
    ran = []
    for rows in batches:
        ran += rows
        spark.createDataFrame([(i, t0 + dt.timedelta(minutes=m), None, "Z", v, None) for i, m, v in rows], st.EVENTS_SCHEMA).write.mode("append").parquet(land)
        st.correct_windows(st.file_stream(spark, land, st.EVENTS_SCHEMA), table, late, ckpt)
        st.correct_windows(st.file_stream(spark, land, st.EVENTS_SCHEMA), table, late, ckpt)  # restart: nothing new
        want = {}
        for _, m, v in ran:
            want.setdefault(m // 60, []).append(v)
        got = {(r["window_start"] - t0).seconds // 3600: (r["load_sum"], r["n"]) for r in tables.scan_layer(spark, table).collect()}
        assert got == {h: (sum(x for x in v if x is not None), len(v)) for h, v in want.items()}
    assert sorted(r["event_id"] for r in spark.read.parquet(late).collect()) == [4, 7]
