"""Calendar features as built-in column expressions, and holiday dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month-day holidays per calendar (fallback set).
HOLIDAYS_MMDD: dict[str, list[str]] = {
    "ES": ["01-01", "01-06", "05-01", "08-15", "10-12", "11-01", "12-06", "12-08", "12-25"],
    "US": ["01-01", "07-04", "11-11", "12-25"],
}

# Known balancing-authority zones and the zones shown as US data.
KNOWN_US_ZONES = ["CAL", "CISO", "ERCO", "MISO", "PJM", "NYIS", "ISNE", "SWPP", "TEX", "NY", "US48"]
US_SOURCE_ZONES = ["CAL", "ERCO", "PJM", "MISO", "NYIS", "ISNE", "SWPP", "US48"]

TWO_PI = 2.0 * math.pi


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week(ts: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts)).cast("bigint")


def calendar_columns(ts: Column | str = "timestamp_utc") -> dict[str, Column]:
    t = _c(ts)
    dow = day_of_week(t)
    return {
        "hour": F.hour(t).cast("bigint"),
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(t).cast("bigint"),
        "month": F.month(t).cast("bigint"),
        "quarter": F.quarter(t).cast("bigint"),
        "year": F.year(t).cast("bigint"),
        "week_of_year": F.weekofyear(t).cast("bigint"),
        "is_weekend": (dow >= 5).cast("bigint"),
    }


def cyclic_columns(hour: str = "hour", dow: str = "day_of_week", month: str = "month") -> dict[str, Column]:
    out = {}
    for name, src, period in (("hour", hour, 24), ("dow", dow, 7), ("month", month, 12)):
        angle = F.lit(TWO_PI) * F.col(src) / F.lit(float(period))
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def zone_to_calendar(zone: Column | str, zone_map: dict[str, str] | None = None) -> Column:
    """Calendar code of a zone: explicit map first, else the upper-cased
    prefix before ``_`` (``DE_LU`` -> ``DE``)."""
    prefix = F.upper(F.substring_index(_c(zone), "_", 1))
    if not zone_map:
        return prefix
    m = F.create_map(*[F.lit(x) for kv in sorted(zone_map.items()) for x in kv])
    return F.coalesce(m[_c(zone)], prefix)


def fixed_holiday_flag(ts: Column | str, calendar: Column) -> Column:
    """1 when the month-day is in the calendar's fixed set."""
    md = F.date_format(_c(ts), "MM-dd")
    expr = F.lit(0)
    for cal, days in HOLIDAYS_MMDD.items():
        expr = F.when((calendar == F.lit(cal)) & md.isin(days), F.lit(1)).otherwise(expr)
    return expr.cast("bigint")


def _nth_weekday(y: Column, month: int, iso_dow: int, n: int) -> Column:
    """n-th given weekday (ISO 1=Mon..7=Sun) of a month."""
    first = F.make_date(y, F.lit(month), F.lit(1))
    first_dow = F.weekday(first) + 1  # ISO
    shift = F.pmod(F.lit(iso_dow) - first_dow, F.lit(7)) + F.lit(7 * (n - 1))
    return F.date_add(first, shift.cast("int"))


def _last_weekday(y: Column, month: int, last_day: int, iso_dow: int) -> Column:
    last = F.make_date(y, F.lit(month), F.lit(last_day))
    back = F.pmod(F.weekday(last) + 1 - F.lit(iso_dow), F.lit(7))
    return F.date_sub(last, back.cast("int"))


def easter_sunday(y: Column) -> Column:
    """Gregorian Easter by the anonymous (Meeus/Jones/Butcher) algorithm."""
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100)
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4)
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4)
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = F.pmod(h + l_ - 7 * m + 114, F.lit(31)) + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


# National public holidays as rules.
#   ("fixed", month, day) | ("nth", month, iso_weekday, n) |
#   ("last", month, last_day_of_month, iso_weekday) | ("easter", day_offset)
# An optional 4th tuple element on "fixed" is the first year it applies.
HOLIDAY_RULES: list[tuple[str, str, tuple]] = [
    ("US", "New Year's Day", ("fixed", 1, 1)),
    ("US", "Martin Luther King Jr. Day", ("nth", 1, 1, 3)),
    ("US", "Washington's Birthday", ("nth", 2, 1, 3)),
    ("US", "Memorial Day", ("last", 5, 31, 1)),
    ("US", "Juneteenth National Independence Day", ("fixed", 6, 19, 2021)),
    ("US", "Independence Day", ("fixed", 7, 4)),
    ("US", "Labor Day", ("nth", 9, 1, 1)),
    ("US", "Columbus Day", ("nth", 10, 1, 2)),
    ("US", "Veterans Day", ("fixed", 11, 11)),
    ("US", "Thanksgiving", ("nth", 11, 4, 4)),
    ("US", "Christmas Day", ("fixed", 12, 25)),
    ("ES", "Año Nuevo", ("fixed", 1, 1)),
    ("ES", "Epifanía del Señor", ("fixed", 1, 6)),
    ("ES", "Viernes Santo", ("easter", -2)),
    ("ES", "Fiesta del Trabajo", ("fixed", 5, 1)),
    ("ES", "Asunción de la Virgen", ("fixed", 8, 15)),
    ("ES", "Fiesta Nacional de España", ("fixed", 10, 12)),
    ("ES", "Todos los Santos", ("fixed", 11, 1)),
    ("ES", "Día de la Constitución Española", ("fixed", 12, 6)),
    ("ES", "Inmaculada Concepción", ("fixed", 12, 8)),
    ("ES", "Navidad", ("fixed", 12, 25)),
]


def rule_date(y: Column, rule: tuple) -> Column:
    kind = rule[0]
    if kind == "fixed":
        d = F.make_date(y, F.lit(rule[1]), F.lit(rule[2]))
        return F.when(y >= F.lit(rule[3]), d) if len(rule) > 3 else d
    if kind == "nth":
        return _nth_weekday(y, rule[1], rule[2], rule[3])
    if kind == "last":
        return _last_weekday(y, rule[1], rule[2], rule[3])
    if kind == "easter":
        return F.date_add(easter_sunday(y), rule[1])
    raise ValueError(rule)


#: Calendars whose fixed-date holidays are also kept on the nearest weekday.
OBSERVED_CALENDARS = {"US"}


def observed_date(y: Column, rule: tuple) -> Column:
    """Weekday of year ``y`` on which a fixed holiday of a weekend is observed:
    Friday before a Saturday, Monday after a Sunday; null if there is none.
    New Year's Day is observed on the last Friday of the year before."""
    day = rule_date(y, rule)
    after = F.when(F.weekday(day) == 6, F.date_add(day, 1))
    if rule[1:3] == (1, 1):
        eve = F.make_date(y, F.lit(12), F.lit(31))
        return F.array(after, F.when(F.weekday(eve) == 4, eve))
    return F.array(after, F.when(F.weekday(day) == 5, F.date_sub(day, 1)))


def holidays_of(y: Column, calendar: str) -> list[tuple[Column, Column]]:
    """``(name, date)`` of every holiday of a calendar in year ``y``; some dates are null."""
    out = []
    for c, name, rule in HOLIDAY_RULES:
        if c == calendar:
            out.append((F.lit(name), rule_date(y, rule)))
            if c in OBSERVED_CALENDARS and rule[0] == "fixed":
                out += [(F.lit(f"{name} (observed)"), observed_date(y, rule)[k]) for k in (0, 1)]
    return out


def movable_holiday_flag(ts: Column | str, calendar: Column) -> Column:
    """1 when the row's date is a rule holiday of its calendar, observed days
    included, evaluated as column expressions of the row's own year: no
    dimension, no join."""
    d = F.to_date(_c(ts))
    y = F.year(_c(ts))
    hit = F.lit(False)
    for cal in sorted({c for c, _, _ in HOLIDAY_RULES}):
        hit = hit | ((calendar == F.lit(cal)) & F.coalesce(d.isin(*[day for _, day in holidays_of(y, cal)]), F.lit(False)))
    return hit.cast("bigint")


def holiday_dimension(years: DataFrame, year_col: str = "year") -> DataFrame:
    """(calendar, holiday_date, name) for every year in ``years``.

    National public holidays as date expressions (fixed month-day, n-th
    weekday, last weekday, Easter offset, observed weekday); about 24 rows per
    year, so it is safe to broadcast."""
    y = F.col(year_col).cast("int")
    entries = F.array(*[F.struct(F.lit(c).alias("calendar"), name.alias("name"), day.alias("holiday_date"))
                        for c in sorted({c for c, _, _ in HOLIDAY_RULES}) for name, day in holidays_of(y, c)])
    return (years.select(F.explode(entries).alias("h"))
            .select("h.calendar", "h.holiday_date", "h.name")
            .filter(F.col("holiday_date").isNotNull())
            .dropDuplicates(["calendar", "holiday_date"]))


def years_of(df: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    """One row per calendar year spanned by ``df`` (from its min/max only)."""
    b = df.agg(F.min(F.year(ts)).alias("y0"), F.max(F.year(ts)).alias("y1"))
    return b.select(F.explode(F.sequence("y0", "y1")).alias("year"))


def years_between(spark: SparkSession, y0: int, y1: int) -> DataFrame:
    return spark.range(y0, y1 + 1).select(F.col("id").cast("int").alias("year"))
