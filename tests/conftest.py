from __future__ import annotations

import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="loadcast-tests-")
    s = (SparkSession.builder.master("local[*]").appName("loadcast-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", f"{scratch}/ckpt")
         .config("spark.sql.warehouse.dir", f"{scratch}/wh")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def sawtooth(hour: int, zone: int) -> float:
    """Load of a zone at an hour: a daily triangle on a weekly staircase, and a
    deterministic wobble."""
    day = hour // 24
    triangle = 1 - abs((hour % 24) - 14) / 14
    step = (0, 2, 3, 3, 2, -4, -6)[day % 7]
    return 900.0 + 250.0 * zone + 400.0 * triangle + 30.0 * step + (hour * 7919 % 97) / 10.0


def _frame(spark, rows):
    return spark.createDataFrame(
        [(t, z, "actual", v, v, False, "ok", t) for t, z, v in rows],
        "timestamp_utc timestamp_ntz, country string, kind string, load_mw double, load_mw_clean double, is_outlier boolean, "
        "quality_flag string, ingested_at timestamp_ntz")


@pytest.fixture(scope="session")
def synthetic(spark):
    """Sixteen days of one zone, every hour present, no randomness."""
    start = dt.datetime(2023, 5, 3)
    return _frame(spark, [(start + dt.timedelta(hours=h), "ES", sawtooth(h, 0)) for h in range(16 * 24)])


@pytest.fixture(scope="session")
def gappy(spark):
    """Two zones over forty days: one with holes of one to thirty hours, the
    other with a row every second hour."""
    start = dt.datetime(2023, 5, 3)
    holes = {h for s in range(50, 960, 110) for h in range(s, s + 1 + s % 30)}
    rows = [(start + dt.timedelta(hours=h), "ES", sawtooth(h, 0)) for h in range(960) if h not in holes]
    rows += [(start + dt.timedelta(hours=h), "US", sawtooth(h, 1)) for h in range(0, 960, 2)]
    return _frame(spark, rows)


@pytest.fixture(scope="session")
def synthetic_gold(spark, synthetic):
    from loadcast.operators.features import build_gold
    return build_gold(synthetic, zone_map={"ES": "ES"}, bucket_steps=None).cache()
