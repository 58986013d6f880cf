from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF01
from loadcast.operators import quality as qa
from loadcast.operators import scoring as sc
from loadcast.session import work_dir
from loadcast.sources import landed, tables
from loadcast.sources import testdata as td


def test_dedup_aggregate_equals_window(spark):
    b = td.bronze_events(spark, SF01)
    order = [F.col("ingested_at"), F.col("event_id")]
    a = qa.dedup_latest(b, order=order, method="aggregate")
    w = qa.dedup_latest(b, order=order, method="window")
    assert sorted(a.collect()) == sorted(w.select(*a.columns).collect())
    assert a.count() == b.select("timestamp_utc", "country").distinct().count()


def _series(spark, values):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(hours=i), "Z", "actual", v, base) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "timestamp_utc timestamp_ntz, country string, kind string, load_mw double, ingested_at timestamp_ntz")


def test_ffill_bounded_to_three_rows(spark):
    df = _series(spark, [1.0, None, None, None, None, None, 2.0])
    out = qa.flag_and_fill(df).orderBy("timestamp_utc").select("load_mw_clean").collect()
    assert [r[0] for r in out] == [1.0, 1.0, 1.0, 1.0, None, None, 2.0]


def test_all_null_fences_flag_nothing(spark):
    df = _series(spark, [None, None, None])
    out = qa.flag_and_fill(df).select("is_outlier", "quality_flag").collect()
    assert all(r["is_outlier"] is None and r["quality_flag"] == "missing" for r in out)


def test_outlier_flag_and_quality(spark):
    vals = [10.0, 11.0, 12.0, 10.5, 11.5, 1000.0, None]
    out = qa.flag_and_fill(_series(spark, vals)).orderBy("timestamp_utc").select("quality_flag").collect()
    assert [r[0] for r in out] == ["ok"] * 5 + ["outlier", "missing"]


def test_nan_becomes_null_in_bronze(spark):
    df = _series(spark, [1.0, float("nan")])
    typed = tables.bronze_typed(df)
    assert typed.filter(F.col("load_mw").isNull()).count() == 1
    assert typed.filter(F.isnan("load_mw")).count() == 0


def test_approx_fences_rank_error(spark):
    """percentile_approx at accuracy 1000 is within 0.001 rank of exact."""
    b = td.bronze_events(spark, SF01)
    n = b.count()
    approx = qa.iqr_fences(b, scope="global", method="approx").first()
    vals = sorted(r[0] for r in b.select("load_mw").collect())
    for q, p in ((approx["q1"], 0.25), (approx["q3"], 0.75)):
        lo = sum(1 for v in vals if v < q) / n
        hi = sum(1 for v in vals if v <= q) / n
        assert lo - 0.001 <= p <= hi + 0.001


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_upsert_is_idempotent(spark, scheme):
    path = scheme + work_dir(spark, "t_upsert")
    first = _series(spark, [1.0, 2.0, 3.0]).union(_series(spark, [9.0]).withColumn("country", F.lit("Y")))
    tables.upsert(spark, first, path)
    base = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([(base + dt.timedelta(hours=2), "Z", "actual", 30.0, base),
                                   (base + dt.timedelta(hours=3), "Z", "actual", 4.0, base),
                                   (base + dt.timedelta(days=40), "Z", "actual", 5.0, base)],
                                  first.schema)
    untouched = [f for f in tables.scan_layer(spark, path).inputFiles() if "country=Y" in f]
    tables.upsert(spark, batch, path)
    once = sorted(tables.scan_layer(spark, path).select("country", "timestamp_utc", "load_mw").collect())
    obs = Observation("after")
    tables.upsert(spark, batch, path, obs=obs)
    twice = sorted(tables.scan_layer(spark, path).select("country", "timestamp_utc", "load_mw").collect())
    assert once == twice
    assert [r[2] for r in once] == [9.0, 1.0, 2.0, 30.0, 4.0, 5.0]
    assert obs.get["rows"] == 6
    assert untouched == [f for f in tables.scan_layer(spark, path).inputFiles() if "country=Y" in f]
    assert tables.exists(spark, path) and not tables.exists(spark, path + "-none")


def test_rejects_are_kept(spark):
    df = _series(spark, [1.0, 2.0, 3.0]).union(_series(spark, [4.0]).withColumn("country", F.lit(None).cast("string")))
    assert tables.bronze_typed(df).count() == 3
    bad = tables.bronze_rejects(df).collect()
    assert [(r["load_mw"], r["reason"]) for r in bad] == [(4.0, "null:country")]


def test_page_rejects(spark):
    path = work_dir(spark, "t_pages")
    page = lambda rows: '{"request": {"respondent": "Z", "start": "2024-01-01T00", "type": "D"}, "response": {"data": [' + rows + "]}}"
    good = '{"period": "2024-01-01T00", "respondent": "Z", "value": 5}'
    lines = [page(good), page('{"period": "2024-01-01T01", "respondent": "Z", "value": "x"}, {"period": "soon", "respondent": null, "value": 1}'),
             '{"request": {}}', "{broken"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    assert [r["load_mw"] for r in landed.scan_json_pages(spark, path).collect()] == [5.0]
    assert sorted(r["reason"] for r in landed.page_rejects(spark, path).collect()) == [
        "no data", "null:load_mw", "null:timestamp_utc,country", "unreadable"]


def test_edge_hours_have_one_survivor(spark):
    t = dt.datetime(2024, 1, 2)
    rows = [(t, "Z", 2.0, "2024-01-02T00", "D"), (t, "Z", 1.0, "2024-01-01T00", "D"), (t, "Z", 0.5, "2023-12-31T00", "DF")]
    pages = spark.createDataFrame(rows, "timestamp_utc timestamp_ntz, country string, load_mw double, window_start string, type string")
    assert [r["load_mw"] for r in landed.pages_to_series(pages, "actual").collect()] == [1.0]
    assert [r["load_mw"] for r in landed.pages_to_series(pages, "forecast").collect()] == [0.5]


def test_every_row_of_a_large_batch_is_scored(spark):
    fields = [f.name for f in sc.ANOMALY_REQUEST.fields]
    req = spark.range(10_001).select(F.lit("d").alias("batch_id"), *[F.lit("1").alias(c) for c in fields])
    req = req.withColumn("timestamp_utc", F.lit("2024-01-01T00"))
    checked = sc.check_request(req, sc.ANOMALY_REQUEST)
    assert checked.filter("valid").count() == 10_001
    assert [(r["status"], r["n"]) for r in sc.score_counters(checked, "anomaly").collect()] == [("scored", 10_001)]
    assert sc.batch_report(checked).first()["batch_status"] == "rejected"


def test_densify_fills_every_hour(spark):
    g = td.load_grid(spark, SF01)
    per_zone = {r[0]: r[1] for r in g.groupBy("country").count().collect()}
    assert set(per_zone.values()) == {720}
    assert g.select("timestamp_utc", "country").distinct().count() == g.count()
