"""Incremental layers: a batch refreshes the months it touches, no others.

Each layer keeps a change log beside its table (``<path>_changes``): one row
per batch, series and month, with the first and last hour that changed.  A
refresh of the next layer takes the entries it has not applied yet
(``<path>_applied``), widens them by the reach of its windows, and so knows the
(zone, month) partitions to rebuild:

- silver: the hours that a bounded forward fill can carry a change into, the
  hours between the old end of a series and a later batch, and the months whose
  outlier flags a moved fence can change.  Statistics per (zone, month), among
  them a mergeable sketch, tell fences and candidates without reading values.
- gold: the hours that lags and rolling windows carry a change into.

Partitions are read by literal zones and months (plus the tail of the month
before, the halo of the windows), computed with one window per (series, month),
staged and put in place by dynamic partition overwrite.  Every step is
idempotent and the log entry is marked as applied last: a run that fails is
repeated with the same outcome.  One writer per table at a time.

The outcome equals a rebuild from all of bronze.  With ``method='exact'`` the
fences need the load column of the touched zones' other months (one column,
flags and fills of those months are not recomputed); with ``'approx'`` merged
sketches stand for it (rank error of ``functions.quantiles.rank_error``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.quantiles import SKETCH
from loadcast.operators import quality as qa
from loadcast.operators.features import add_calendar, add_holidays, drop_incomplete_lags, lag_columns, roll_columns
from loadcast.schemas import BRONZE_SCHEMA, DEFAULT_LAGS, DEFAULT_ROLLS, SILVER_COLUMNS, TARGET
from loadcast.session import work_dir
from loadcast.sources.tables import MONTH, exists, replace_partitions, scan_partitions

PARTS = ["country", MONTH]
_NTZ, _STR, _DBL, _LONG = T.TimestampNTZType(), T.StringType(), T.DoubleType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


CHANGES = _schema(("seq", _LONG), ("country", _STR), ("kind", _STR), ("lo", _NTZ), ("hi", _NTZ), ("flags_only", T.BooleanType()))
APPLIED = _schema(("seq", _LONG))
FENCES = _schema(("seq", _LONG), ("country", _STR), ("lower", _DBL), ("upper", _DBL))
STATS = _schema(("kind", _STR), ("rows", _LONG), ("n", _LONG), ("least", _DBL), ("most", _DBL), ("first_ts", _NTZ), ("last_ts", _NTZ),
                ("sketch", T.BinaryType()), ("country", _STR), (MONTH, _STR))
BRONZE = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(MONTH, _STR)])
SILVER = _schema(("timestamp_utc", _NTZ), ("country", _STR), ("kind", _STR), ("load_mw", _DBL), ("load_mw_clean", _DBL),
                 ("is_outlier", T.BooleanType()), ("quality_flag", _STR), ("ingested_at", _NTZ), (MONTH, _STR))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def month_of(ts) -> F.Column:
    return F.date_format(ts, "yyyy-MM")


def month_start(month) -> F.Column:
    return F.to_timestamp_ntz(F.concat(month, F.lit("-01")), F.lit("yyyy-MM-dd"))


def _months(lo, hi) -> F.Column:
    """Every month that [lo, hi] meets."""
    first, last = F.trunc(lo, "month"), F.trunc(hi, "month")
    return F.transform(F.sequence(first, F.greatest(first, last), F.expr("INTERVAL 1 MONTH")), lambda d: F.date_format(d, "yyyy-MM"))


def log_changes(changes: DataFrame, path: str, seq: int) -> None:
    """Append ``(country, kind, lo, hi[, flags_only])`` under one number."""
    if "flags_only" not in changes.columns:
        changes = changes.withColumn("flags_only", F.lit(False))
    (changes.select(F.lit(seq).cast("bigint").alias("seq"), "country", "kind", "lo", "hi", "flags_only")
     .coalesce(1).write.mode("append").parquet(f"{path}_changes"))


def next_seq(spark: SparkSession, path: str) -> int:
    return (_read(spark, f"{path}_changes", CHANGES).agg(F.max("seq")).first()[0] or 0) + 1


def batch_changes(batch: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    """Changed hours of a batch of rows, per series and month."""
    return (batch.groupBy("country", "kind", month_of(ts).alias("m")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
            .select("country", "kind", "lo", "hi"))


def pending(spark: SparkSession, source: str, path: str) -> tuple[DataFrame, int]:
    """Changes of ``source`` that the table at ``path`` has not applied, and
    the newest number (0: nothing to do)."""
    done = _read(spark, f"{path}_applied", APPLIED).agg(F.max("seq")).first()[0] or 0
    log = _read(spark, f"{source}_changes", CHANGES).filter(F.col("seq") > done)
    newest = log.agg(F.max("seq")).first()[0] or 0
    return log, newest


def _mark(spark: SparkSession, path: str, seq: int) -> None:
    spark.createDataFrame([(seq,)], APPLIED).write.mode("append").parquet(f"{path}_applied")


def _halo(touched: DataFrame, rows: DataFrame, hours: int, ts: str = "timestamp_utc") -> DataFrame:
    """``rows`` of touched months and the last ``hours`` before each, as copies:
    ``_m`` is the month that a copy serves, ``_own`` whether it lies in it."""
    start = month_start(F.col(MONTH))
    following = F.add_months(start, 1)
    tail = F.col(ts) >= following.cast("timestamp_ntz") - F.make_interval(hours=F.lit(hours))
    copies = F.array_compact(F.array(F.struct(F.col(MONTH).alias("m"), F.lit(True).alias("own")),
                                     F.when(tail, F.struct(F.date_format(following, "yyyy-MM").alias("m"), F.lit(False).alias("own")))))
    served = rows.withColumn("_c", F.explode(copies)).withColumn("_m", F.col("_c.m")).withColumn("_own", F.col("_c.own")).drop("_c", MONTH)
    return served.join(touched.select("country", F.col(MONTH).alias("_m")), ["country", "_m"], "left_semi")


def with_months_before(touched: DataFrame) -> DataFrame:
    before = F.date_format(F.add_months(month_start(F.col(MONTH)), -1), "yyyy-MM")
    return touched.select(*PARTS).unionByName(touched.select("country", before.alias(MONTH))).distinct()


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def silver_stats(core: DataFrame) -> DataFrame:
    """One row per (zone, month, kind): extent, extremes and a sketch of the loads."""
    return core.groupBy("kind", *PARTS).agg(
        F.count(F.lit(1)).alias("rows"), F.count("load_mw").alias("n"), F.min("load_mw").alias("least"), F.max("load_mw").alias("most"),
        F.min("timestamp_utc").alias("first_ts"), F.max("timestamp_utc").alias("last_ts"),
        F.kll_sketch_agg_double("load_mw", F.lit(SKETCH)).alias("sketch")).select(*STATS.names)


def for_all(zones: DataFrame, fences: DataFrame) -> DataFrame:
    """The one row of ``fences`` beside every zone (scalar subqueries)."""
    return zones.withColumns({c: fences.select(c).scalar() for c in ("lower", "upper")})


def sketch_fences(stats: DataFrame, k: float = 3.0, scope: str = "zone") -> DataFrame:
    """Fences from merged sketches: ``(country, lower, upper)``."""
    keys = ["country"] if scope == "zone" else []
    some = stats.filter("n > 0")
    q = some.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("s"), F.count(F.lit(1)).alias("c")).filter("c > 0")
    q = q.select(*keys, *[F.kll_sketch_get_quantile_double("s", F.lit(p)).alias(n) for n, p in (("q1", 0.25), ("q3", 0.75))])
    q = q.select(*keys, (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"), (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"))
    zones = stats.select("country").distinct()
    return zones.join(q, "country", "left") if keys else for_all(zones, q)


def _flagged(core: DataFrame, fences: DataFrame) -> DataFrame:
    return (core.join(fences.select("country", "lower", "upper"), "country", "left")
            .withColumn("is_outlier", qa.outlier_flag()).withColumn("quality_flag", qa.quality_flag()).select(*SILVER.names))


def refresh_silver(spark: SparkSession, bronze_path: str, silver_path: str, method: str = "approx", scope: str = "zone",
                   k: float = 3.0, ffill_rows: int = 3) -> dict[str, int]:
    """Bring silver up to date with bronze; returns what was done:
    rows written, partitions rebuilt, re-flagged and read."""
    log, seq = pending(spark, bronze_path, silver_path)
    if not seq:
        return {"rows": 0, "rebuilt": 0, "reflagged": 0, "read": 0}
    folder, reach = work_dir(spark, "silver-refresh"), F.make_interval(hours=F.lit(ffill_rows))
    stats = _read(spark, f"{silver_path}_stats", STATS)
    old = stats.groupBy("country", "kind").agg(F.min("first_ts").alias("first"), F.max("last_ts").alias("last"))
    new = log.groupBy("country", "kind").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    extent = _stored(new.join(old, ["country", "kind"], "full")
                     .select("country", "kind", "lo", "hi", "last", F.least("first", "lo").alias("begin"), F.greatest("last", "hi").alias("end"), "first"),
                     folder, "extent")
    # What changes in silver: the batch and the hours a fill reaches; the hours between it and an older or newer end.
    span = log.select("country", "kind", "lo", (F.col("hi") + reach).alias("hi"))
    after = extent.filter("lo > last").select("country", "kind", F.col("last").alias("lo"), F.col("lo").alias("hi"))
    ahead = extent.filter("hi < first").select("country", "kind", F.col("hi").alias("lo"), F.col("first").alias("hi"))
    span = span.unionByName(after).unionByName(ahead).join(extent.select("country", "kind", "begin", "end"), ["country", "kind"])
    changed = _stored(span.select("country", "kind", F.greatest("lo", "begin").alias("lo"), F.least("hi", "end").alias("hi"))
                      .withColumn("m", F.explode(_months(F.col("lo"), F.col("hi"))))
                      .groupBy("country", "kind", F.col("m").alias(MONTH)).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), folder, "changed")
    touched = _stored(changed.select(*PARTS).distinct(), folder, "touched")
    needed = with_months_before(touched)
    bronze = scan_partitions(spark, bronze_path, needed, BRONZE)
    latest = qa.dedup_latest(bronze).drop(MONTH)
    # Hourly grid of every touched month and the hours before it, inside the extent of the series.
    start, hour = month_start(F.col(MONTH)), F.expr("INTERVAL 1 HOUR")
    a = F.greatest(start - reach, "begin")
    z = F.least(F.add_months(start, 1).cast("timestamp_ntz") - hour, "end")
    grid = (touched.join(extent.select("country", "kind", "begin", "end"), "country").filter(a <= z)
            .select("country", "kind", F.col(MONTH).alias("_m"), F.explode(F.sequence(a, z, hour)).alias("timestamp_utc")))
    filled = grid.join(latest, ["country", "kind", "timestamp_utc"], "left")
    w = Window.partitionBy("country", "kind", "_m").orderBy("timestamp_utc")
    core = (filled.withColumn("load_mw_clean", qa.ffill("load_mw", ffill_rows)(w)).filter(month_of("timestamp_utc") == F.col("_m"))
            .select("timestamp_utc", "country", "kind", "load_mw", "load_mw_clean", "ingested_at", F.col("_m").alias(MONTH)))
    core = _stored(core, folder, "core")
    own = _stored(silver_stats(core), folder, "stats")
    rest = stats.join(touched, PARTS, "left_anti")
    zones = touched.select("country").distinct()
    if scope == "zone":
        rest = rest.join(zones, "country", "left_semi")
    rest = _stored(rest, folder, "rest")
    if method == "approx":
        fences = sketch_fences(rest.unionByName(own), k, scope)
    else:
        # One column of the other months; they are read again only to be re-flagged.
        values = core.select("country", "load_mw").unionByName(
            scan_partitions(spark, silver_path, rest.select(*PARTS).distinct(), SILVER).select("country", "load_mw"))
        fences = qa.iqr_fences(values, scope=scope, k=k)
        if scope != "zone":
            fences = for_all(rest.unionByName(own).select("country").distinct(), fences)
    fences = _stored(fences.select("country", "lower", "upper"), folder, "fences")
    before = (_read(spark, f"{silver_path}_fences", FENCES).groupBy("country")
              .agg(F.max_by(F.struct("lower", "upper"), "seq").alias("b")).select("country", F.col("b.lower").alias("l0"), F.col("b.upper").alias("u0")))
    moved = (fences.join(before, "country", "left")
             .filter(~(F.col("lower").eqNullSafe(F.col("l0")) & F.col("upper").eqNullSafe(F.col("u0")))))
    crossed = (F.col("least") < F.greatest("lower", "l0")) | (F.col("most") > F.least("upper", "u0"))
    unknown = F.col("lower").isNull() | F.col("l0").isNull()
    reflag = _stored(rest.filter("n > 0").join(moved, "country").filter(unknown | crossed).select(*PARTS).distinct(), folder, "reflag")
    again = scan_partitions(spark, silver_path, reflag, SILVER).select(*core.columns)
    obs = Observation("silver")
    out = _stored(_flagged(core.unionByName(again), fences).observe(obs, F.count(F.lit(1)).alias("rows")), folder, "silver")
    replace_partitions(out, silver_path, touched.unionByName(reflag), sort_within=["kind", "timestamp_utc"])
    replace_partitions(own, f"{silver_path}_stats", touched)
    (fences.select(F.lit(seq).cast("bigint").alias("seq"), "*").coalesce(1).write.mode("append").parquet(f"{silver_path}_fences"))
    flags = reflag.select("country", F.lit("actual").alias("kind"), month_start(F.col(MONTH)).alias("lo")).withColumn("hi", F.col("lo"))
    log_changes(changed.select("country", "kind", "lo", "hi").withColumn("flags_only", F.lit(False))
                .unionByName(flags.withColumn("flags_only", F.lit(True))), silver_path, next_seq(spark, silver_path))
    _mark(spark, silver_path, seq)
    return {"rows": int(obs.get["rows"]), "rebuilt": touched.count(), "reflagged": reflag.count(), "read": needed.count()}


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str, zone_map: dict[str, str] | None = None,
                 lags=DEFAULT_LAGS, rolls=DEFAULT_ROLLS, holidays: str = "movable") -> dict[str, int]:
    """Bring gold up to date with silver: the months that changed and those
    that lags and rolling windows carry a change into."""
    log, seq = pending(spark, silver_path, gold_path)
    if not seq:
        return {"rows": 0, "rebuilt": 0, "read": 0}
    folder, reach = work_dir(spark, "gold-refresh"), max(*lags, *rolls)
    hi = F.when(F.col("flags_only"), F.col("hi")).otherwise(F.col("hi") + F.make_interval(hours=F.lit(reach)))
    last = _read(spark, f"{silver_path}_stats", STATS).filter("kind = 'actual'").groupBy("country").agg(F.max("last_ts").alias("last"))
    span = log.filter("kind = 'actual'").join(last, "country").select("country", "lo", F.least(hi, "last").alias("hi"))
    touched = _stored(span.select("country", F.explode(_months(F.col("lo"), F.col("hi"))).alias(MONTH)).distinct(), folder, "touched")
    needed = with_months_before(touched)
    rows = scan_partitions(spark, silver_path, needed, SILVER).filter("kind = 'actual'")
    w = Window.partitionBy("country", "kind", "_m").orderBy("timestamp_utc")
    served = _halo(touched, rows, reach)
    featured = served.withColumns({**lag_columns(TARGET, lags)(w), **roll_columns(TARGET, rolls)(w)}).filter("_own")
    gold = drop_incomplete_lags(add_holidays(add_calendar(featured), zone_map=zone_map, mode=holidays))
    made = [c for c in gold.columns if c not in (*SILVER_COLUMNS, "_own", "_m")]
    obs = Observation("gold")
    out = _stored(gold.select(*SILVER_COLUMNS, *made, F.col("_m").alias(MONTH)).observe(obs, F.count(F.lit(1)).alias("rows")), folder, "gold")
    replace_partitions(out, gold_path, touched)
    log_changes(log.select("country", "kind", "lo", "hi", "flags_only"), gold_path, next_seq(spark, gold_path))
    _mark(spark, gold_path, seq)
    return {"rows": int(obs.get["rows"]), "rebuilt": touched.count(), "read": needed.count()}
