"""Time expressions: parsing to UTC, hour truncation, offsets, key formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(ts: Column | str) -> Column:
    """Truncate to the hour, keeping ``timestamp_ntz`` (UTC wall clock)."""
    return F.date_trunc("hour", col(ts)).cast("timestamp_ntz")


def day_floor(ts: Column | str) -> Column:
    return F.date_trunc("day", col(ts)).cast("timestamp_ntz")


def parse_utc(value: Column | str, fmt: str | None = None,
              source_tz: Column | str | None = None) -> Column:
    """String or timestamp -> UTC ``timestamp_ntz``.

    Unparseable strings become NULL (``try_to_timestamp``).  When the input
    carries an offset (``...+02:00``) Spark converts it; ``source_tz`` turns a
    zone-less local wall clock into UTC.
    """
    c = col(value)
    if fmt is None:
        parsed = F.try_to_timestamp(c.cast("string"))
    else:
        parsed = F.try_to_timestamp(c.cast("string"), F.lit(fmt))
    if source_tz is not None:
        tz = F.lit(source_tz) if isinstance(source_tz, str) else source_tz
        parsed = F.to_utc_timestamp(parsed.cast("timestamp_ntz").cast("timestamp"), tz)
    return parsed.cast("timestamp_ntz")


def date_offset(ts: Column | str, days: int = 0, hours: int = 0) -> Column:
    """ts + days + hours, as an interval expression (negative to go back)."""
    return col(ts) + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days), F.lit(hours))


def hour_key(ts: Column | str) -> Column:
    """Request key format ``yyyy-MM-ddTHH``."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH")


def report_tag(ts: Column | str) -> Column:
    """Report tag format ``yyyyMMdd_HHmm``."""
    return F.date_format(col(ts), "yyyyMMdd_HHmm")


def epoch_hours(ts: Column | str) -> Column:
    """Whole hours since 1970-01-01 (UTC), bigint."""
    return F.floor(F.unix_micros(col(ts).cast("timestamp")) / F.lit(3_600_000_000)).cast("bigint")
