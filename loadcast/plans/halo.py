"""Halo-bucketed series windows.

A window partitioned only by zone puts a whole zone's history in one task.
To spread one long series over many tasks, rows are cut into fixed time
buckets of ``bucket_steps`` grid steps; the last ``halo_steps`` rows of each
bucket are also copied into the next bucket (flagged as halo).  Row frames
then see every predecessor they need inside their own (zone, bucket)
partition, results are computed there, and halo copies are dropped.

Buckets are cut over row positions.  On a dense grid (one row per step, as
``densify`` makes it; ``dense=True``) the position follows from the time.  A
series that may have gaps is numbered first: rows are counted per (series, time
bucket), the counts are summed up along the series, and rows are numbered
inside their time bucket; so a halo holds the preceding rows whatever the gaps,
and no series is sorted in one task.  Cost: ``halo_steps / bucket_steps`` extra
rows and one shuffle on (zone keys, bucket); one more, and a second pass over
the input, with gaps.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadcast.functions.timecols import epoch_hours

_B, _H, _P, _N = "_halo_bucket", "_halo_copy", "_halo_part", "_halo_row"


def series_window(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column] | list[dict[str, Column]]],
    keys: Sequence[str] = ("country", "kind"),
    ts: str = "timestamp_utc",
    lookback: int = 0,
    bucket_steps: int | None = None,
    step_hours: int = 1,
    dense: bool = False,
) -> DataFrame:
    """Add ``columns(w)`` where ``w`` is the per-series window ordered by ts.

    ``columns`` may return a list of dicts: stages applied in order, so a
    later stage can read an earlier stage's output (same spec: no new
    shuffle).  ``lookback`` is the largest number of preceding rows any column reads
    (for chained columns, the sum).  ``bucket_steps=None`` keeps one window
    partition per series.  ``dense`` states that every step of a series has a
    row; results are the same without it.
    """
    keys = list(keys)
    if bucket_steps is None:
        return _apply(df, columns(Window.partitionBy(*keys).orderBy(ts)))
    if lookback > bucket_steps:
        raise ValueError("halo (lookback) must not exceed the bucket length")
    original = df.columns
    if dense:
        step = F.floor(epoch_hours(ts) / F.lit(step_hours))
    else:
        df = _numbered(df, keys, ts, bucket_steps * step_hours)
        step = F.col(_N)
    bucket = F.floor(step / F.lit(bucket_steps)).cast("bigint")
    pos = step - bucket * F.lit(bucket_steps)
    own = F.struct(bucket.alias("b"), F.lit(False).alias("h"))
    nxt = F.struct((bucket + 1).alias("b"), F.lit(True).alias("h"))
    copies = F.when(F.lit(lookback > 0) & (pos >= F.lit(bucket_steps - lookback)),
                    F.array(own, nxt)).otherwise(F.array(own))
    exploded = (df.withColumn("_hc", F.explode(copies))
                .withColumn(_B, F.col("_hc.b")).withColumn(_H, F.col("_hc.h")).drop("_hc"))
    # Explicit hash partitioning on (keys, bucket): without it Spark may keep
    # an existing partitioning on the zone alone (it satisfies the window's
    # clustering), which would put a whole zone back into one task.
    # One hash column of (keys, bucket) leads the window spec, so that single
    # partitioning satisfies the window whatever the optimizer folds away.
    exploded = exploded.withColumn(_P, F.xxhash64(*[F.col(k) for k in keys], F.col(_B))).repartition(_P)
    w = Window.partitionBy(_P, *keys, _B).orderBy(ts)
    out = _apply(exploded, columns(w)).filter(~F.col(_H))
    new_cols = [c for c in out.columns if c not in (_B, _H, _P, _N) and c not in original]
    return out.select(*original, *new_cols)


def _numbered(df: DataFrame, keys: list[str], ts: str, hours: int) -> DataFrame:
    """Add the position of each row in its series, from 0, in two levels."""
    part = F.floor(epoch_hours(ts) / F.lit(hours)).cast("bigint")
    df = df.withColumn(_B, part).withColumn(_P, F.xxhash64(*[F.col(k) for k in keys], F.col(_B)))
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    counts = (df.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("_n"))
              .select(*keys, _B, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy(_P, *keys, _B).orderBy(ts)) - 1
    return df.withColumn(_N, inside).join(counts, [*keys, _B]).withColumn(_N, F.col(_N) + F.col("_before")).drop("_before", _B, _P)


def _apply(df: DataFrame, stages) -> DataFrame:
    for stage in (stages if isinstance(stages, list) else [stages]):
        df = df.withColumns(stage)
    return df
