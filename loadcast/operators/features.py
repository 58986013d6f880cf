"""Gold-layer features: calendar, holidays, lags and leak-free rolling stats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions import calendar as cal
from loadcast.operators.quality import ffill
from loadcast.plans.halo import series_window
from loadcast.schemas import DEFAULT_LAGS, DEFAULT_ROLLS, TARGET, lag_name, roll_names


def add_calendar(df: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    df = df.withColumns(cal.calendar_columns(ts))
    return df.withColumns(cal.cyclic_columns())


def add_holidays(df: DataFrame, ts: str = "timestamp_utc", zone: str = "country",
                 zone_map: dict[str, str] | None = None, mode: str = "movable") -> DataFrame:
    """is_holiday (and its alias is_holiday_es) for the zone's calendar.

    ``mode='fixed'`` checks the month-day fallback set; ``'movable'`` checks
    the national rules (fixed dates, n-th weekdays, Easter offsets) computed
    from each row's own year, so the flag is a pure projection (no join and
    no extra pass over the data to find the year span).
    """
    calendar = cal.zone_to_calendar(zone, zone_map)
    flag = cal.fixed_holiday_flag(ts, calendar) if mode == "fixed" else cal.movable_holiday_flag(ts, calendar)
    return df.withColumn("is_holiday", flag).withColumn("is_holiday_es", F.col("is_holiday"))


def lag_columns(target: str = TARGET, lags: Sequence[int] = DEFAULT_LAGS, horizon: int = 1):
    """Factory: lag_k = value k rows back (k >= horizon only)."""
    def make(w):
        return {lag_name(target, k): F.lag(target, k).over(w) for k in lags if k >= horizon}
    return make


def roll_columns(target: str = TARGET, windows: Sequence[int] = DEFAULT_ROLLS, horizon: int = 1):
    """Factory: mean / sample std of the w rows ending ``horizon`` rows back
    (horizon 1 = previous w rows, current row excluded: no leakage)."""
    def make(w):
        out = {}
        for n in windows:
            frame = w.rowsBetween(-n - horizon + 1, -horizon)
            m, s = roll_names(target, n)
            out[m] = F.avg(target).over(frame)
            out[s] = F.stddev_samp(target).over(frame)
        return out
    return make


def add_lags_rolls(df: DataFrame, target: str = TARGET, lags: Sequence[int] = DEFAULT_LAGS,
                   rolls: Sequence[int] = DEFAULT_ROLLS, horizon: int = 1,
                   bucket_steps: int | None = None, step_hours: int = 1, dense: bool = False) -> DataFrame:
    """Lags and rolls over one window spec (one Exchange + Sort)."""
    lookback = max([*lags, *[r + horizon - 1 for r in rolls], 0])

    def cols(w):
        return {**lag_columns(target, lags, horizon)(w), **roll_columns(target, rolls, horizon)(w)}

    return series_window(df, cols, lookback=lookback, bucket_steps=bucket_steps, step_hours=step_hours, dense=dense)


def lag_by_time(df: DataFrame, target: str = TARGET, lags: Sequence[int] = DEFAULT_LAGS,
                keys: Sequence[str] = ("country", "kind"), ts: str = "timestamp_utc",
                unit: str = "HOUR") -> DataFrame:
    """lag_k = value at exactly ts - k units, as an equi-join (no densify).

    Each row is emitted once per lag at ts + k; one aggregation on
    (keys, ts) pivots them, then one left join on the same keys.  Two
    shuffles whatever the number of lags; keys must be unique per ts.
    """
    keys = list(keys)
    shifted = F.array(*[F.struct(F.lit(k).alias("k"),
                                 (F.col(ts) + F.expr(f"INTERVAL {k} {unit}")).alias("t"))
                        for k in lags])
    long = (df.select(*keys, F.col(target).alias("_v"), F.explode(shifted).alias("_s"))
            .select(*keys, F.col("_s.t").alias(ts), F.col("_s.k").alias("_k"), "_v"))
    wide = long.groupBy(*keys, ts).pivot("_k", list(lags)).agg(F.first("_v"))
    wide = wide.select(*keys, ts, *[F.col(str(k)).alias(lag_name(target, k)) for k in lags])
    return df.join(wide, [*keys, ts], "left").select(*df.columns, *[lag_name(target, k) for k in lags])


def drop_incomplete_lags(df: DataFrame, target: str = TARGET) -> DataFrame:
    prefix = f"{target}_lag_"
    return df.na.drop(subset=[c for c in df.columns if c.startswith(prefix)])


def build_gold(silver: DataFrame, target: str = TARGET, lags: Sequence[int] = DEFAULT_LAGS,
               rolls: Sequence[int] = DEFAULT_ROLLS, zone_map: dict[str, str] | None = None,
               holidays: str = "movable", horizon: int = 1, bucket_steps: int | None = 2016,
               step_hours: int = 1, ffill_rows: int | None = None, drop: bool = True,
               dense: bool = False) -> DataFrame:
    """silver -> gold: calendar + holidays + lags + rolls (+ drop incomplete).

    All series windows share one (zone, kind[, bucket]) window spec, so the
    plan has one Exchange + Sort.  With ``ffill_rows`` the bounded forward
    fill of ``load_mw`` into ``target`` runs in the same pass (halo widened
    by ``ffill_rows``).
    """
    df = add_holidays(add_calendar(silver), zone_map=zone_map, mode=holidays)
    lookback = max([*lags, *[r + horizon - 1 for r in rolls], 0]) + (ffill_rows or 0)

    def stages(w):
        out = []
        if ffill_rows is not None:
            out.append({target: ffill("load_mw", ffill_rows)(w)})
        out.append({**lag_columns(target, lags, horizon)(w), **roll_columns(target, rolls, horizon)(w)})
        return out

    df = series_window(df, stages, lookback=lookback, bucket_steps=bucket_steps, step_hours=step_hours, dense=dense)
    return drop_incomplete_lags(df, target) if drop else df
