from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loadcast.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("sketch", [4096, 512])
def test_equal_to_percentile(spark, sketch):
    rng = random.Random(3)
    rows = [(rng.choice("aabc"), rng.choice([None, 1.0, 1.0, 2.5, rng.gauss(0, 9)])) for _ in range(5000)] + [("one", 4.0), ("none", None), ("none", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    df2 = df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    want = {r.g: r.q for r in df2.groupBy("g").agg(F.percentile("v", PROBS).alias("q")).collect()}
    got = {r.g: r.q for r in exact_quantiles(df, "v", PROBS, ["g"], sketch).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == (want[g] if want[g] is None else pytest.approx(want[g]))
    whole = df2.agg(F.percentile("v", PROBS).alias("q")).first().q
    assert exact_quantiles(df, "v", PROBS, (), sketch).first().q == pytest.approx(whole)
    assert exact_quantiles(df.filter("v is null"), "v", PROBS).first().q is None
    assert "percentile(" not in exact_quantiles(df, "v", PROBS, ["g"])._jdf.queryExecution().optimizedPlan().toString()
