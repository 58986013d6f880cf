from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loadcast.operators import quality as qa
from loadcast.operators.features import build_gold
from loadcast.plans import incremental as inc
from loadcast.plans import jobs
from loadcast.schemas import SILVER_COLUMNS
from loadcast.session import work_dir
from loadcast.sources import tables

SCHEMA = "timestamp_utc timestamp_ntz, country string, load_mw double, kind string"
START = dt.datetime(2023, 1, 1)


def value(zone, h):
    return 500.0 + 40 * (h % 24) + 3 * (h % 7) + (h * 7919 % 101) + 1000 * (zone == "B")


def hours(zone, a, z, skip=lambda h: False, kind="actual", add=0.0):
    return [(START + dt.timedelta(hours=h), zone, value(zone, h) + add, kind) for h in range(a, z) if not skip(h)]


def snapshot(path):
    out = {}
    for folder, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.relpath(os.path.join(folder, f), path)] = os.stat(os.path.join(folder, f)).st_mtime_ns
    return out


def parts(files):
    return {os.path.dirname(f) for f in files}


def full(spark, bronze, scope):
    b = tables.scan_layer(spark, bronze).select("timestamp_utc", "country", "kind", "load_mw", "ingested_at")
    grid = qa.densify(qa.dedup_latest(b), bounds="zone")
    return qa.silver_projection(qa.flag_and_fill(grid, scope=scope))


def same(a, b, cols):
    rows = lambda d: sorted(map(repr, d.select(*[F.round(c, 9) if t == "double" else F.col(c) for c, t in d.select(*cols).dtypes]).collect()))
    return [r.split("(", 1)[1] for r in rows(a)] == [r.split("(", 1)[1] for r in rows(b)]


@pytest.mark.parametrize("scope", ["zone", "global"])
def test_equal_to_rebuild_and_only_touched_months(spark, scope):
    root = work_dir(spark, "t_inc")
    bronze, silver, gold = (os.path.join(root, x) for x in ("bronze", "silver", "gold"))
    gap = lambda h: 400 < h < 420 or h % 97 == 5
    batches = [
        hours("A", 0, 150 * 24, gap) + hours("B", 30 * 24, 120 * 24, gap) + hours("A", 24, 60, kind="forecast"),
        hours("A", 70 * 24, 71 * 24, add=11.0),                 # one day again
        # after a hole of three days; outliers that move a fence; hours restated as missing
        hours("B", 123 * 24, 124 * 24) + [(START + dt.timedelta(hours=h), "A", 90_000.0, "actual") for h in range(1000, 1003)]
        + [(START + dt.timedelta(hours=h), "A", None, "actual") for h in range(2000, 2006)],
        hours("B", 0, 5),                                       # before the start
        hours("C", 200, 230),                                   # a new zone; taken together with the one before
    ]
    zone_map = {"A": "ES", "B": "US"}
    for n, rows in enumerate(batches if scope == "zone" else batches[::2]):
        read = {"x": lambda rows=rows: spark.createDataFrame(rows, SCHEMA)}
        jobs.job_bronze(spark, read, "x", bronze, START + dt.timedelta(days=1000 + n))
        if n == 3:
            continue  # two batches taken at once
        old_silver, old_gold = snapshot(silver), snapshot(gold)
        s = inc.refresh_silver(spark, bronze, silver, "exact", scope)
        g = inc.refresh_gold(spark, silver, gold, zone_map)
        want = full(spark, bronze, scope)
        got = tables.scan_layer(spark, silver).select(*SILVER_COLUMNS)
        assert same(got, want, SILVER_COLUMNS), n
        plain = build_gold(got.filter("kind = 'actual'"), zone_map=zone_map, bucket_steps=None)
        assert same(tables.scan_layer(spark, gold), plain, plain.columns), n
        if n == 1 and scope == "zone":  # a day in March: that month, and gold's next if lags reach it
            touched = parts(set(snapshot(silver).items()) ^ set(old_silver.items()) and {f for f, t in set(snapshot(silver).items()) ^ set(old_silver.items())})
            assert s["rebuilt"] == 1 and s["read"] == 2 and "country=A/_month=2023-03" in touched
            assert len(touched) == 1 + s["reflagged"] and all("country=A" in p for p in touched)
            regold = parts({f for f, t in set(snapshot(gold).items()) ^ set(old_gold.items())})
            assert g["rebuilt"] <= 1 + s["reflagged"] and len(regold) == g["rebuilt"] and len(parts(snapshot(gold))) > g["rebuilt"]
    assert inc.refresh_silver(spark, bronze, silver, "exact", scope)["rows"] == 0 and inc.refresh_gold(spark, silver, gold)["rows"] == 0


def test_sketched_fences_stay_near_exact_ones(spark):
    root = work_dir(spark, "t_inc_approx")
    bronze, silver = os.path.join(root, "bronze"), os.path.join(root, "silver")
    for a, z in ((0, 80 * 24), (80 * 24, 81 * 24), (81 * 24, 120 * 24)):
        jobs.job_bronze(spark, {"x": lambda a=a, z=z: spark.createDataFrame(hours("A", a, z), SCHEMA)}, "x", bronze, START)
        done = inc.refresh_silver(spark, bronze, silver)
    values = sorted(value("A", h) for h in range(120 * 24))
    f = spark.read.parquet(f"{silver}_fences").orderBy(F.desc("seq")).first()
    iqr = (f["upper"] - f["lower"]) / 7
    q1, q3 = f["lower"] + 3 * iqr, f["upper"] - 3 * iqr
    for q, p in ((q1, 0.25), (q3, 0.75)):
        assert abs(sum(v <= q for v in values) / len(values) - p) < 0.01
    assert done["rebuilt"] == 2  # of four months: the rest of March, April


def test_a_partition_that_loses_its_rows_goes(spark):
    path = work_dir(spark, "t_gone")
    df = spark.createDataFrame([("A", "2023-01", 1), ("B/x", "2023-01", 2)], f"country string, {tables.MONTH} string, v int")
    df.write.partitionBy("country", tables.MONTH).parquet(path)
    tables.replace_partitions(df.filter("v = 1").withColumn("v", F.lit(5)), path, df.select("country", tables.MONTH))
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [5]


def test_many_small_partitions_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(40 * 24).selectExpr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id as int)) as timestamp_utc", "concat('Z', id % 4) as country",
                                           "'actual' as kind", "cast(id as double) as load_mw")
    writers = lambda path: {f.split("/")[-1].split("-")[1] for f in snapshot(path)}
    path = f"{tmp_path}/t"
    tables.create_table(rows, path)
    assert len(snapshot(path)) > 3 * tables.FOLDERS_A_TASK and len(writers(path)) > 2
    assert tables.scan_layer(spark, path).count() == rows.count()
    tables.upsert(spark, rows.withColumn("load_mw", F.col("load_mw") + 1), path)
    assert len(writers(path)) > 2
    assert tables.scan_layer(spark, path).select(F.sum("load_mw")).first()[0] == rows.select(F.sum(F.col("load_mw") + 1)).first()[0]


def test_a_large_partition_is_left_to_a_rebalance(spark, monkeypatch):
    rows = spark.range(100).selectExpr("id % 3 as a")
    plan = lambda: tables.dealt(rows, ["a"])._jdf.queryExecution().logical().toString()
    assert "rebalance" not in plan().lower()
    monkeypatch.setattr(tables, "SMALL_PARTITION", 10)
    assert "rebalance" in plan().lower()


def test_pages_and_bounds_come_from_a_stored_grid(spark):
    from loadcast.queries import q_jobs
    sf = "/root/testdata/sf0.001"
    grid = q_jobs._grid(spark, sf)
    plan = grid.select(q_jobs._as_of(grid).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "event" not in plan and grid.count() > 0
    assert not any("events" in f for f in grid.inputFiles())
