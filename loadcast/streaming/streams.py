"""Structured Streaming twins of the batch operators.

Every stream reads files (the landing zone), keeps its state and offsets in
a checkpoint under the shared checkpoint root, and runs with
``trigger(availableNow=True)`` so a scheduled job drains what has landed and
stops; a restart resumes from the checkpoint (exactly-once with the file
source and idempotent sinks).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.timecols import epoch_hours, hour_floor
from loadcast.operators.quality import dedup_latest
from loadcast.schemas import DEFAULT_LAGS, DEFAULT_ROLLS, TARGET, lag_name, roll_names
from loadcast.sources import tables

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def as_bronze(ev: DataFrame) -> DataFrame:
    return ev.select(hour_floor("ts").alias("timestamp_utc"), F.col("event_type").alias("country"),
                     F.lit("actual").alias("kind"), F.col("value").alias("load_mw"),
                     F.col("ts").alias("ingested_at"), "event_id")


def event_instant(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant (``timestamp``); the stored UTC wall clock
    (``timestamp_ntz``) maps to it one-to-one in a UTC session."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def drain(writer, checkpoint: str) -> None:
    """Run a stream until the landed input is consumed, then stop."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def stream_upsert(stream: DataFrame, table: str, checkpoint: str, key: Sequence[str] = ("timestamp_utc", "country", "kind"),
                  order: Sequence[str] = ("ingested_at", "event_id")) -> None:
    """Idempotent incremental load: each micro-batch is reduced to one row
    per key and upserted; a replayed batch rewrites the same rows."""
    def merge(batch: DataFrame, _epoch: int) -> None:
        latest = dedup_latest(batch, key, order=[F.col(c) for c in order])
        tables.upsert(batch.sparkSession, latest, table, key)
    drain(stream.writeStream.foreachBatch(merge), checkpoint)


def stream_dedup(stream: DataFrame, sink: str, checkpoint: str, key: Sequence[str] = ("timestamp_utc", "country", "kind"),
                 event_time: str = "ingested_at", delay: str = "3 hours") -> None:
    """First arrival per key among rows no later than ``delay``; state older
    than the watermark is dropped."""
    out = (event_instant(stream, event_time).withWatermark(event_time, delay)
           .dropDuplicatesWithinWatermark(list(key)).withColumn(event_time, F.col(event_time).cast("timestamp_ntz")))
    drain(out.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)


def windowed_load(stream: DataFrame, duration: str = "1 hour", slide: str | None = None, delay: str = "1 hour",
                  ts: str = "ts", zone: str = "event_type", value: str = "value") -> DataFrame:
    """Event-time windows per zone with a watermark (append mode emits a
    window once the watermark passes its end)."""
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    return (event_instant(stream, ts).withWatermark(ts, delay).groupBy(w.alias("w"), F.col(zone).alias("country"))
            .agg(F.sum(value).alias("load_sum"), F.avg(value).alias("load_avg"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "country", "load_sum", "load_avg", "n"))


FEATURE_STATE = "last_hour long, raw array<double>, clean array<double>"
FEATURES = ("timestamp_utc timestamp_ntz, country string, kind string, load_mw double, load_mw_clean double, late boolean, "
            + ", ".join(f"{c} double" for c in [*[lag_name(TARGET, k) for k in DEFAULT_LAGS], *[c for n in DEFAULT_ROLLS for c in roll_names(TARGET, n)]]))


def hourly_features(raw: np.ndarray, before_raw: np.ndarray, before_clean: np.ndarray, fill: int, lags: Sequence[int],
                    rolls: Sequence[int], chunk: int = 4096) -> dict[str, np.ndarray]:
    """Filled values, lags and rolling statistics of consecutive hours (NaN:
    missing), given the ``fill`` raw and the filled values before them."""
    reach, n = len(before_clean), len(raw)
    known = np.concatenate((before_raw, raw))
    clean = raw.copy()
    for k in range(1, fill + 1):
        clean = np.where(np.isnan(clean), known[fill - k:fill - k + n], clean)
    line = np.concatenate((before_clean, clean))
    out = {TARGET: clean} | {lag_name(TARGET, k): line[reach - k:reach - k + n] for k in lags}
    for w in rolls:
        mean, std = np.empty(n), np.empty(n)
        for s in range(0, n, chunk):
            frame = np.lib.stride_tricks.sliding_window_view(line[reach - w + s:reach - 1 + min(n, s + chunk)], w)
            held = ~np.isnan(frame)
            c, v = held.sum(axis=1), np.where(held, frame, 0.0)
            with np.errstate(invalid="ignore", divide="ignore"):
                m = v.sum(axis=1) / c
                off = np.where(held, frame - m[:, None], 0.0)
                mean[s:s + len(c)] = m
                std[s:s + len(c)] = np.where(c > 1, np.sqrt((off * off).sum(axis=1) / (c - 1)), np.nan)
        out |= dict(zip(roll_names(TARGET, w), (mean, std), strict=True))
    return out


def stream_features(stream: DataFrame, fill: int = 3, lags: Sequence[int] = DEFAULT_LAGS, rolls: Sequence[int] = DEFAULT_ROLLS) -> DataFrame:
    """Features of arriving hours, as the batch operators make them.

    State per (zone, kind): the newest hour, the last raw values (for the bounded
    fill) and the last filled ones (for lags and rolls), a bounded array each.
    Hours that a series skips are inserted as missing, so a row is an hour.  Of
    several rows of an hour in a batch the last by ``ingested_at`` (then by load)
    counts.  A row that is not after the newest hour comes out ``late``, without
    features: the caller sends it through the table's upsert."""
    reach, names = max(*lags, *rolls), [f.split()[0] for f in FEATURES.split(", ")]

    def advance(key, parts, state):
        rows = pd.concat(list(parts), ignore_index=True).sort_values(["hour", "ingested_at", "load_mw"], na_position="first")
        rows = rows.drop_duplicates("hour", keep="last")
        last, raw, clean = state.get if state.exists else (None, [], [])
        late = rows[rows["hour"] <= last] if last is not None else rows[:0]
        rows = rows[rows["hour"] > last] if last is not None else rows
        out = []
        if len(late):
            out.append(pd.DataFrame({"hour": late["hour"], "load_mw": late["load_mw"], "late": True}))
        if len(rows):
            first = int(rows["hour"].iloc[0]) if last is None else last + 1
            hours = np.arange(first, int(rows["hour"].iloc[-1]) + 1)
            load = np.full(len(hours), np.nan)
            load[rows["hour"].to_numpy() - first] = rows["load_mw"].to_numpy(float)
            pad = lambda x, size: np.concatenate((np.full(size, np.nan), np.array([np.nan if v is None else v for v in x], float)))[-size:]
            made = hourly_features(load, pad(raw, fill), pad(clean, reach), fill, lags, rolls)
            out.append(pd.DataFrame({"hour": hours, "load_mw": load, "late": False} | made))
            keep = lambda old, new, size: [None if np.isnan(v) else float(v) for v in np.concatenate((pad(old, size), new))[-size:]]
            state.update((int(hours[-1]), keep(raw, load, fill), keep(clean, made[TARGET], reach)))
        for o in out:
            o["country"], o["kind"] = key
            o["timestamp_utc"] = pd.to_datetime(o["hour"], unit="h")
            yield o.reindex(columns=names).astype({c: float for c in names if c not in ("timestamp_utc", "country", "kind", "late")})

    hourly = stream.select("country", "kind", epoch_hours("timestamp_utc").alias("hour"), "load_mw", "ingested_at")
    made = hourly.groupBy("country", "kind").applyInPandasWithState(advance, FEATURES, FEATURE_STATE, "append", "NoTimeout")
    # NaN is how pandas says missing.
    return made.select(*[F.when(~F.isnan(n), F.col(n)).alias(n) if t == "double" else F.col(n) for n, t in made.dtypes])


def correct_windows(stream: DataFrame, table: str, late: str, checkpoint: str, delay: str = "1 hour") -> None:
    """Hourly windows per zone that late rows correct.

    A micro-batch is reduced to its windows' partial sums, kept in a folder of
    their own (a replayed batch replaces it); the windows it touches are summed
    up over all batches and upserted, so late rows re-emit their windows.  Rows
    whose window had closed when they came (newest time of earlier batches, less
    ``delay``) are also put in ``late``, batch by batch."""
    parts = f"{table}_parts"
    schema = "window_start timestamp_ntz, country string, s double, n long, newest timestamp_ntz, _month string, epoch long"

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        start = hour_floor("ts")
        seen = spark.read.schema(schema).parquet(parts) if tables.exists(spark, parts) else None
        if seen is not None:
            closed = seen.filter(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
            if closed is not None:
                limit = F.lit(closed).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
                (batch.filter(start + F.expr("INTERVAL 1 HOUR") <= limit).write.mode("overwrite").parquet(f"{late}/epoch={epoch}"))
        (batch.groupBy(start.alias("window_start"), F.col("event_type").alias("country"))
         .agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"))
         .withColumn(tables.MONTH, F.date_format("window_start", "yyyy-MM")).withColumn("epoch", F.lit(epoch))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", tables.MONTH).parquet(parts))
        seen = spark.read.schema(schema).parquet(parts)
        mine = seen.filter(F.col("epoch") == epoch).select("country", "window_start", tables.MONTH)
        of_months = tables.pruned_to(seen.filter(F.col("epoch") <= epoch), mine.select(tables.MONTH).distinct())
        whole = (of_months.join(mine.drop(tables.MONTH), ["country", "window_start"], "left_semi")
                 .groupBy("window_start", "country").agg(F.sum("s").alias("load_sum"), F.sum("n").alias("n"))
                 .select("window_start", "country", "load_sum", (F.col("load_sum") / F.col("n")).alias("load_avg"), "n"))
        tables.upsert(spark, whole, table, key=("window_start", "country"), ts="window_start")
    drain(stream.writeStream.foreachBatch(merge), checkpoint)


def stream_to_parquet(df: DataFrame, sink: str, checkpoint: str) -> None:
    drain(df.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> None:
    """Score each micro-batch with a fitted model.  A batch has a folder of its
    own, so one that is replayed replaces its rows instead of adding them.  Late
    rows of ``stream_features`` go to ``<sink>_late``, unscored."""
    def run(batch: DataFrame, epoch: int) -> None:
        if "late" in batch.columns:
            batch = batch.persist()  # the state advances once a batch
            batch.filter("late").select("timestamp_utc", "country", "kind", "load_mw").write.mode("overwrite").parquet(f"{sink}_late/epoch={epoch}")
            score(batch.filter("not late").drop("late")).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")
            batch.unpersist()
            return
        score(batch).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")
    drain(stream.writeStream.foreachBatch(run), checkpoint)
