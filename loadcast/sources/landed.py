"""Landed API pages (JSON) and other load-series sources.

A page is one JSON document ``{"request": {...}, "response": {"data": [
{"period": "yyyy-MM-ddTHH", "respondent": zone, "value": ...}, ...]}}``.
Pages cover fetch windows that share their edge hour.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.timecols import hour_key, parse_utc

PAGE_SCHEMA = T.StructType([
    T.StructField("request", T.StructType([
        T.StructField("respondent", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("type", T.StringType()),
    ])),
    T.StructField("response", T.StructType([
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("period", T.StringType()),
            T.StructField("respondent", T.StringType()),
            T.StructField("value", T.StringType()),  # numbers and numeric strings both arrive as text
        ]))),
    ])),
    T.StructField("_corrupt_record", T.StringType()),
])


def plan_fetch_windows(start: Column, end: Column, days: int = 60) -> Column:
    """Array of (window_start, window_end) structs covering [start, end):
    fixed ``days`` steps, the last one clipped to ``end``; neighbours share
    their edge instant."""
    step = F.expr(f"INTERVAL {days} DAY")
    starts = F.filter(F.sequence(start, end, step), lambda s: s < end)
    return F.transform(starts, lambda s: F.struct(s.alias("window_start"),
                                                  F.least(s + step, end).alias("window_end")))


def write_landed_pages(series: DataFrame, path: str, days: int = 60, ts: str = "timestamp_utc",
                       value: str = "load_mw", zone: str = "country", kind: str = "actual") -> str:
    """Write one page per (zone, fetch window) as JSON lines.

    Window membership is arithmetic on the row's offset from the global
    start (scalar subqueries), so no join; a row on a shared edge goes to
    both pages.  A page holds at most ``days * 24 + 1`` rows.
    """
    b = series.select(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi"))).scalar()
    series = series.withColumn("_b", b)
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    secs = F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(lo.cast("timestamp"))
    span = days * 86400
    n_win = F.greatest(F.ceil((F.unix_seconds(hi.cast("timestamp")) - F.unix_seconds(lo.cast("timestamp"))) / span), F.lit(1))
    k = F.least(F.floor(secs / span), n_win - 1)
    on_edge = (F.pmod(secs, F.lit(span)) == 0) & (secs > 0) & (F.floor(secs / span) <= n_win - 1)
    ks = F.when(on_edge, F.array(k - 1, k)).otherwise(F.array(k))
    rows = series.select(zone, ts, value, "_b", F.explode(ks).alias("_k"))
    entry = F.struct(hour_key(ts).alias("period"), F.col(zone).alias("respondent"),
                     F.col(value).cast("string").alias("value"))
    w_start = F.col("_lo") + F.make_interval(days=F.col("_k") * days)
    w_end = F.least(w_start + F.expr(f"INTERVAL {days} DAY"), F.col("_hi"))
    pages = (rows.groupBy(zone, "_k")
             .agg(F.sort_array(F.collect_list(entry)).alias("data"), F.min("_b.lo").alias("_lo"), F.min("_b.hi").alias("_hi"))
             .select(F.to_json(F.struct(
                 F.struct(F.col(zone).alias("respondent"), hour_key(w_start).alias("start"),
                          hour_key(w_end).alias("end"), kind_code(F.lit(kind)).alias("type")).alias("request"),
                 F.struct(F.col("data")).alias("response"))).alias("value")))
    pages.write.mode("overwrite").text(path)
    return path


def read_pages(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw page documents; unreadable documents land in ``_corrupt_record``."""
    return (spark.read.schema(PAGE_SCHEMA).option("multiLine", multiline)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def _entries(pages: DataFrame) -> DataFrame:
    """Typed page entries beside their raw text and the request they answer."""
    return pages.select("request", F.explode("response.data").alias("d")).select(
        parse_utc(F.col("d.period"), "yyyy-MM-dd'T'HH").alias("timestamp_utc"),
        F.col("d.respondent").alias("country"),
        F.expr("try_cast(d.value AS DOUBLE)").alias("load_mw"),
        F.col("request.start").alias("window_start"), F.col("request.type").alias("type"), F.to_json("d").alias("raw"))


def scan_json_pages(spark: SparkSession, path: str, keep_nulls: bool = False, multiline: bool = False,
                    with_request: bool = False) -> DataFrame:
    """response.data[] -> (timestamp_utc, country, load_mw), with the request's
    window start and type code if asked for; bad numbers and bad periods become
    NULL.  What is left out (incomplete entries, unreadable pages and pages
    without data) is what ``page_rejects`` returns."""
    out = _entries(read_pages(spark, path, multiline))
    out = out.select("timestamp_utc", "country", "load_mw", *(("window_start", "type") if with_request else ()))
    return out if keep_nulls else out.na.drop(subset=["timestamp_utc", "country", "load_mw"])


def page_rejects(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """(raw, reason) of all that ``scan_json_pages`` leaves out: unreadable
    documents, pages without ``response.data``, entries without a usable
    period, zone or value."""
    pages = read_pages(spark, path, multiline)
    bad = pages.select(F.coalesce("_corrupt_record", F.to_json(F.struct("request", "response"))).alias("raw"), F.when(
        F.col("_corrupt_record").isNotNull(), F.lit("unreadable")).when(F.col("response.data").isNull(), F.lit("no data")).alias("reason"))
    entries = _entries(pages)
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("timestamp_utc", "country", "load_mw")]))
    rows = entries.select("raw", F.concat(F.lit("null:"), F.array_join(lacking, ",")).alias("reason")).filter(F.size(lacking) > 0)
    return bad.filter("reason is not null").unionByName(rows)


def page_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per page: respondent, window, number of data entries, status, read
    with JSON path extraction on the raw text (missing keys -> 'malformed')."""
    raw = spark.read.text(path)
    data = F.get_json_object("value", "$.response.data")
    n = F.json_array_length(data)
    return raw.select(
        F.get_json_object("value", "$.request.respondent").alias("respondent"),
        F.get_json_object("value", "$.request.start").alias("window_start"),
        F.get_json_object("value", "$.request.end").alias("window_end"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("n_rows"),
        F.when(data.isNull(), F.lit("malformed")).when(n == 0, F.lit("empty")).otherwise(F.lit("ok")).alias("status"),
    )


def kind_code(kind: Column | str) -> Column:
    """Request type code: actual demand 'D', otherwise day-ahead forecast 'DF'."""
    k = F.col(kind) if isinstance(kind, str) else kind
    return F.when(k == "actual", F.lit("D")).otherwise(F.lit("DF"))


def pages_to_series(pages: DataFrame, kind: str = "actual") -> DataFrame:
    """Union of page rows -> one row per (hour, zone, kind).  An edge hour is on
    two pages: the one of the earlier window wins, then the smaller value.  Rows
    that carry the request's type code keep to pages of ``kind``."""
    if "type" in pages.columns:
        pages = pages.filter(F.coalesce(F.col("type") == kind_code(F.lit(kind)), F.lit(True)))
    first = F.struct(F.col("window_start") if "window_start" in pages.columns else F.lit(""), F.col("load_mw"))
    out = pages.groupBy("timestamp_utc", "country").agg(F.min_by("load_mw", first).alias("load_mw"))
    return out.select("timestamp_utc", "country", "load_mw", F.lit(kind).alias("kind"))


def known_zone_check(zones: DataFrame, known: DataFrame, zone: str = "country") -> DataFrame:
    """Zones not in the known-zone dimension (left anti join)."""
    return zones.select(zone).distinct().join(known.select(F.col("zone").alias(zone)), zone, "left_anti")


def scan_load_series(df: DataFrame, ts: str, zone: str, kind: str = "actual",
                     source_tz: str | None = None) -> DataFrame:
    """One-column load frame -> canonical (timestamp_utc, country, load_mw, kind);
    when several value columns exist the first one wins."""
    values = [c for c in df.columns if c != ts]
    if not values:
        raise ValueError("no value column")
    return df.select(parse_utc(F.col(ts), source_tz=source_tz).alias("timestamp_utc"), F.lit(zone).alias("country"),
                     F.col(values[0]).cast("double").alias("load_mw"), F.lit(kind).alias("kind"))


def unpivot_generation(wide: DataFrame, ids: Sequence[str] = ("timestamp_utc", "country"),
                       var: str = "source", value: str = "generation_mw") -> DataFrame:
    """Wide fuel columns -> long (ids, source, generation_mw); NULLs kept."""
    values = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), values, var, value)


def source_dispatch(readers: dict[str, Callable[..., DataFrame]], name: str, *args, **kwargs) -> DataFrame:
    """Pick a reader by name; unknown names are rejected."""
    try:
        reader = readers[name.lower()]
    except KeyError:
        raise ValueError(f"unknown source {name!r}; expected one of {sorted(readers)}") from None
    return reader(*args, **kwargs)


def ingest_window(df: DataFrame, as_of: dt.datetime, days: int = 7, ts: str = "ts") -> DataFrame:
    """Raw rows whose hour lies in [as_of - days, as_of]; ``as_of`` is passed in,
    never the wall clock.  Both bounds are literals on the stored time, so they
    reach the scan."""
    hour = as_of.replace(minute=0, second=0, microsecond=0)
    start = as_of - dt.timedelta(days=days)
    first = start if start == start.replace(minute=0, second=0, microsecond=0) else start.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    literal = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast(dict(df.dtypes)[ts])
    return df.filter((F.col(ts) >= literal(first)) & (F.col(ts) < literal(hour + dt.timedelta(hours=1))))
