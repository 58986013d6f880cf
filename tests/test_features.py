from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001, SF01
from loadcast.functions import calendar as cal
from loadcast.operators import features as feat
from loadcast.plans import layers
from loadcast.schemas import FEATURE_COLS


def test_gold_has_feature_columns(synthetic_gold):
    assert set(FEATURE_COLS) <= set(synthetic_gold.columns)
    assert synthetic_gold.count() == 16 * 24 - 168


def test_cyclic_in_range(synthetic_gold):
    for c in ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]:
        lo, hi = synthetic_gold.agg(F.min(c), F.max(c)).first()
        assert -1.0 <= lo and hi <= 1.0


def test_weekend_iff_dow_ge_5(synthetic_gold):
    bad = synthetic_gold.filter((F.col("is_weekend") == 1) != (F.col("day_of_week") >= 5)).count()
    assert bad == 0


def test_first_24_lags_null(spark, synthetic):
    g = feat.build_gold(synthetic, bucket_steps=None, drop=False).orderBy("timestamp_utc")
    lags = [r[0] for r in g.select("load_mw_clean_lag_24").collect()]
    assert all(v is None for v in lags[:24]) and all(v is not None for v in lags[24:])


def test_rolling_mean_is_not_the_target(synthetic_gold):
    same = synthetic_gold.filter(F.abs(F.col("load_mw_clean_roll_mean_24") - F.col("load_mw_clean")) < 1e-9).count()
    assert same < synthetic_gold.count()


def test_pandas_parity_lags_and_rolls(spark, synthetic):
    """Same values as pandas shift / rolling(min_periods=1) on the shifted series."""
    g = feat.build_gold(synthetic, bucket_steps=None, drop=False).orderBy("timestamp_utc").toPandas()
    y = g["load_mw_clean"]
    for k in (1, 24, 48, 168):
        np.testing.assert_allclose(g[f"load_mw_clean_lag_{k}"].to_numpy(dtype=float), y.shift(k).to_numpy(dtype=float),
                                   rtol=0, atol=1e-9, equal_nan=True)
    s = y.shift(1)
    for w in (24, 168):
        np.testing.assert_allclose(g[f"load_mw_clean_roll_mean_{w}"].to_numpy(dtype=float),
                                   s.rolling(w, min_periods=1).mean().to_numpy(), atol=1e-7, equal_nan=True)
        np.testing.assert_allclose(g[f"load_mw_clean_roll_std_{w}"].to_numpy(dtype=float),
                                   s.rolling(w, min_periods=1).std().to_numpy(), atol=1e-7, equal_nan=True)


def _rows(df, cols):
    return sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                  for r in df.select(*cols).collect())


def test_halo_buckets_equal_one_partition(spark):
    """Halo-bucketed windows give the same features as one window per zone,
    on the gappy sf0.001 grid (nulls, partial frames) with small buckets."""
    silver = layers.silver_grid(spark, SF001)
    cols = ["timestamp_utc", "country"] + [c for c in FEATURE_COLS if c.startswith("load_mw_clean")]
    plain = feat.build_gold(silver, bucket_steps=None, drop=False)
    halo = feat.build_gold(silver, bucket_steps=200, drop=False)
    assert _rows(plain, cols) == _rows(halo, cols)


def test_halo_buckets_are_exact_with_gaps(spark, gappy):
    """Row lags and rolls of series with holes do not depend on the buckets."""
    cols = ["timestamp_utc", "country"] + [c for c in FEATURE_COLS if c.startswith("load_mw_clean")]
    plain = feat.build_gold(gappy, bucket_steps=None)
    for steps in (170, 400, 2016):
        assert _rows(feat.build_gold(gappy, bucket_steps=steps), cols) == _rows(plain, cols)
    assert plain.filter("country = 'US'").count() == 480 - 168


def test_halo_chained_ffill(spark):
    """ffill and lags in one halo pass (lookback widened) equal the two-pass result."""
    from loadcast.sources import testdata as td
    from loadcast.operators.quality import flag_and_fill
    grid = td.load_grid(spark, SF001)
    two_pass = feat.build_gold(flag_and_fill(grid), bucket_steps=None, drop=False)
    one_pass = feat.build_gold(flag_and_fill(grid).drop("load_mw_clean"), bucket_steps=180, dense=True, ffill_rows=3, drop=False)
    cols = ["timestamp_utc", "country", "load_mw_clean", "load_mw_clean_lag_1", "load_mw_clean_lag_168",
            "load_mw_clean_roll_std_24"]
    assert _rows(two_pass, cols) == _rows(one_pass, cols)


def test_lag_by_time_equals_row_lags_on_dense_grid(spark):
    silver = layers.silver_grid(spark, SF01)
    by_rows = feat.add_lags_rolls(silver, rolls=(), bucket_steps=None)
    by_time = feat.lag_by_time(silver)
    cols = ["timestamp_utc", "country", "load_mw_clean_lag_1", "load_mw_clean_lag_24", "load_mw_clean_lag_168"]
    assert _rows(by_rows, cols) == _rows(by_time, cols)


def test_holiday_rules_known_dates(spark):
    dim = cal.holiday_dimension(cal.years_between(spark, 2023, 2025))
    got = {(r["calendar"], r["holiday_date"]) for r in dim.collect()}
    for c, d in [("US", dt.date(2024, 1, 15)), ("US", dt.date(2024, 5, 27)), ("US", dt.date(2024, 11, 28)),
                 ("US", dt.date(2025, 9, 1)), ("US", dt.date(2023, 6, 19)), ("ES", dt.date(2024, 3, 29)),
                 ("ES", dt.date(2025, 4, 18)), ("ES", dt.date(2023, 4, 7)), ("ES", dt.date(2024, 12, 8))]:
        assert (c, d) in got, (c, d)
    assert ("US", dt.date(2024, 3, 29)) not in got
    observed = {r["holiday_date"] for r in cal.holiday_dimension(cal.years_between(spark, 2020, 2023)).filter("name like '%(observed)'").collect()}
    assert observed == {dt.date(2020, 7, 3), dt.date(2021, 6, 18), dt.date(2021, 7, 5), dt.date(2021, 12, 24), dt.date(2021, 12, 31),
                        dt.date(2022, 6, 20), dt.date(2022, 12, 26), dt.date(2023, 1, 2), dt.date(2023, 11, 10)}


def test_movable_flag_matches_dimension(spark):
    from loadcast.sources import testdata as td
    d = td.orders_daily(spark, SF01)
    flagged = feat.add_holidays(d, zone_map=layers.ORDERS_ZONE_MAP)
    dim = cal.holiday_dimension(cal.years_of(d))
    keyed = d.withColumn("calendar", cal.zone_to_calendar("country", layers.ORDERS_ZONE_MAP)) \
             .withColumn("holiday_date", F.to_date("timestamp_utc"))
    joined = keyed.join(dim, ["calendar", "holiday_date"], "left_semi").count()
    assert flagged.filter("is_holiday = 1").count() == joined > 0


def test_fixed_fallback_flag(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 10), "ES"), (dt.datetime(2024, 1, 6, 10), "US"),
                                (dt.datetime(2024, 7, 4, 0), "US_EAST")], "timestamp_utc timestamp_ntz, country string")
    out = feat.add_holidays(df, mode="fixed").orderBy("country").select("country", "is_holiday").collect()
    assert [(r[0], r[1]) for r in out] == [("ES", 1), ("US", 0), ("US_EAST", 1)]
