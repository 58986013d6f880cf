"""DuckDB twins of the fixture views and shared SQL helpers.

Each helper returns a CTE body; queries compose them with ``with_(...)``.
"""

from __future__ import annotations

import calendar
import datetime as dt

from dateutil.easter import easter

from loadcast.functions.calendar import HOLIDAYS_MMDD
from loadcast.sources.testdata import FIXTURE_ZONE_MAP


def rnd(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 6)"


def with_(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in ctes)


LOAD_HOURLY = """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp_utc, event_type AS country,
       'actual' AS kind, sum(value) AS load_mw, max(ts) AS ingested_at
FROM events GROUP BY 1, 2, 3"""

BRONZE_EVENTS = """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp_utc, event_type AS country,
       'actual' AS kind, value AS load_mw, ts AS ingested_at, event_id
FROM events"""


def grid_of(src: str, step: str = "1 HOUR") -> str:
    return f"""SELECT z.timestamp_utc, z.country, z.kind, s.load_mw, s.ingested_at
FROM (SELECT zz.country, zz.kind, hh.timestamp_utc
      FROM (SELECT DISTINCT country, kind FROM {src}) zz
      CROSS JOIN (SELECT unnest(generate_series((SELECT min(timestamp_utc) FROM {src}),
                                                (SELECT max(timestamp_utc) FROM {src}),
                                                INTERVAL {step})) AS timestamp_utc) hh) z
LEFT JOIN {src} s ON s.country = z.country AND s.kind = z.kind AND s.timestamp_utc = z.timestamp_utc"""


def grid_zone_of(src: str, step: str = "1 HOUR") -> str:
    """Densify with each zone's own [min, max]."""
    return f"""SELECT z.timestamp_utc, z.country, z.kind, s.load_mw, s.ingested_at
FROM (SELECT country, kind, unnest(generate_series(min(timestamp_utc), max(timestamp_utc), INTERVAL {step})) AS timestamp_utc
      FROM {src} GROUP BY country, kind) z
LEFT JOIN {src} s ON s.country = z.country AND s.kind = z.kind AND s.timestamp_utc = z.timestamp_utc"""


ORDERS_DAILY_RAW = """SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS timestamp_utc, o_orderpriority AS country,
       'actual' AS kind, sum(o_totalprice) AS load_mw, max(o_orderdate) AS ingested_at
FROM orders GROUP BY 1, 2, 3"""


def fences_of(src: str, value: str = "load_mw", scope: str = "zone", k: float = 3.0) -> str:
    by = "country, " if scope == "zone" else ""
    grp = "GROUP BY country" if scope == "zone" else ""
    return f"""SELECT {by}q1, q3, q3 - q1 AS iqr, q1 - {k} * (q3 - q1) AS lower, q3 + {k} * (q3 - q1) AS upper
FROM (SELECT {by}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3 FROM {src} {grp}) q"""


def silver_of(src: str, fences: str, scope: str = "zone", rows: int = 3) -> str:
    on = "USING (country)" if scope == "zone" else "ON TRUE"
    out = "(g.load_mw < f.lower OR g.load_mw > f.upper)"
    return f"""SELECT g.timestamp_utc, g.country, g.kind, g.load_mw,
       coalesce(g.load_mw, last_value(g.load_mw IGNORE NULLS) OVER (PARTITION BY g.country, g.kind
                ORDER BY g.timestamp_utc ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW)) AS load_mw_clean,
       {out} AS is_outlier,
       CASE WHEN g.load_mw IS NULL THEN 'missing' WHEN {out} THEN 'outlier' ELSE 'ok' END AS quality_flag,
       g.ingested_at
FROM {src} g LEFT JOIN {fences} f {on}"""


def calendar_sql(ts: str = "timestamp_utc") -> str:
    return f"""CAST(hour({ts}) AS BIGINT) AS hour, CAST(isodow({ts}) - 1 AS BIGINT) AS day_of_week,
       CAST(day({ts}) AS BIGINT) AS day_of_month, CAST(month({ts}) AS BIGINT) AS month,
       CAST(quarter({ts}) AS BIGINT) AS quarter, CAST(year({ts}) AS BIGINT) AS year,
       CAST(week({ts}) AS BIGINT) AS week_of_year, CAST(isodow({ts}) >= 6 AS BIGINT) AS is_weekend"""


def cyclic_sql() -> str:
    parts = []
    for name, src, period in (("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12)):
        parts.append(f"sin(2 * pi() * {src} / {float(period)}) AS {name}_sin")
        parts.append(f"cos(2 * pi() * {src} / {float(period)}) AS {name}_cos")
    return ", ".join(parts)


def zone_calendar_sql(zone: str = "country", zone_map: dict | None = FIXTURE_ZONE_MAP) -> str:
    prefix = f"upper(split_part({zone}, '_', 1))"
    if not zone_map:
        return prefix
    cases = " ".join(f"WHEN {zone} = '{z}' THEN '{c}'" for z, c in sorted(zone_map.items()))
    return f"CASE {cases} ELSE {prefix} END"


def national_holidays(year: int) -> list[tuple[str, dt.date]]:
    """Holidays of a year by plain date arithmetic, apart from the engine's rules."""
    def nth(month: int, weekday: int, n: int) -> dt.date:
        days = [d for d in calendar.Calendar().itermonthdates(year, month) if d.month == month and d.weekday() == weekday]
        return days[n]

    fixed = [(1, 1), (7, 4), (11, 11), (12, 25)] + ([(6, 19)] if year >= 2021 else [])
    us = [dt.date(year, m, d) for m, d in fixed]
    us += [nth(1, 0, 2), nth(2, 0, 2), nth(5, 0, -1), nth(9, 0, 0), nth(10, 0, 1), nth(11, 3, 3)]
    for y in (year, year + 1):  # observed weekdays, the eve of a New Year on a Saturday among them
        for m, d in fixed:
            day = dt.date(y, m, d)
            us += [o for o in [day + dt.timedelta(days={5: -1, 6: 1}.get(day.weekday(), 0))] if o.year == year and o != day]
    es = [dt.date(year, m, d) for m, d in [(1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25)]]
    es.append(easter(year) - dt.timedelta(days=2))
    return sorted({("US", d) for d in us} | {("ES", d) for d in es})


#: Years of the test data.
HOLIDAY_YEARS = [*range(1992, 2005), *range(2022, 2027)]


def holiday_dim_sql(src: str, ts: str = "timestamp_utc") -> str:
    """Dates written out, for the years that the data span."""
    rows = ", ".join(f"('{c}', DATE '{d}')" for y in HOLIDAY_YEARS for c, d in national_holidays(y))
    return f"""SELECT calendar, holiday_date FROM (VALUES {rows}) h(calendar, holiday_date)
WHERE year(holiday_date) BETWEEN (SELECT min(year({ts})) FROM {src}) AND (SELECT max(year({ts})) FROM {src})"""


def holiday_flag_sql(ts: str = "timestamp_utc", zone: str = "country", dim: str = "hol") -> str:
    return (f"CAST(EXISTS (SELECT 1 FROM {dim} hd WHERE hd.calendar = {zone_calendar_sql(zone)} "
            f"AND hd.holiday_date = CAST({ts} AS DATE)) AS BIGINT)")


def fixed_holiday_sql(ts: str = "timestamp_utc", zone: str = "country") -> str:
    cal = zone_calendar_sql(zone)
    cases = " ".join(
        f"WHEN {cal} = '{c}' AND strftime({ts}, '%m-%d') IN ({', '.join(repr(d) for d in days)}) THEN 1"
        for c, days in HOLIDAYS_MMDD.items())
    return f"CAST(CASE {cases} ELSE 0 END AS BIGINT)"


def lags_rolls_sql(target: str = "load_mw_clean", lags=(1, 24, 48, 168), rolls=(24, 168), horizon: int = 1,
                   part: str = "country, kind", order: str = "timestamp_utc") -> str:
    w = f"PARTITION BY {part} ORDER BY {order}"
    cols = [f"lag({target}, {k}) OVER ({w}) AS {target}_lag_{k}" for k in lags if k >= horizon]
    for n in rolls:
        lo, hi = n + horizon - 1, horizon
        frame = f"ROWS BETWEEN {lo} PRECEDING AND {hi} PRECEDING"
        cols.append(f"avg({target}) OVER ({w} {frame}) AS {target}_roll_mean_{n}")
        cols.append(f"stddev_samp({target}) OVER ({w} {frame}) AS {target}_roll_std_{n}")
    return ", ".join(cols)


# ----- composed fixture CTEs ------------------------------------------------

def grid_ctes() -> list[tuple[str, str]]:
    return [("load_hourly", LOAD_HOURLY), ("load_grid", grid_of("load_hourly"))]


def silver_ctes() -> list[tuple[str, str]]:
    return grid_ctes() + [("fences", fences_of("load_grid")), ("silver", silver_of("load_grid", "fences"))]


def gold_ctes(src: str = "silver", lags=(1, 24, 48, 168), rolls=(24, 168), horizon: int = 1,
              holidays: str = "movable", drop: bool = True) -> list[tuple[str, str]]:
    ctes = [("hol", holiday_dim_sql(src))]
    flag = holiday_flag_sql() if holidays == "movable" else fixed_holiday_sql()
    ctes.append(("cal", f"SELECT *, {calendar_sql()} FROM {src}"))
    ctes.append(("cyc", f"SELECT *, {cyclic_sql()}, {flag} AS is_holiday FROM cal"))
    ctes.append(("feat", f"SELECT *, is_holiday AS is_holiday_es, {lags_rolls_sql(lags=lags, rolls=rolls, horizon=horizon)} FROM cyc"))
    lag_cols = [f"load_mw_clean_lag_{k}" for k in lags if k >= horizon]
    where = " AND ".join(f"{c} IS NOT NULL" for c in lag_cols) if drop else "TRUE"
    ctes.append(("gold", f"SELECT * FROM feat WHERE {where}"))
    return ctes


GOLD_COLUMNS = (
    ["timestamp_utc", "country", "kind", "load_mw", "load_mw_clean", "is_outlier", "quality_flag", "ingested_at",
     "hour", "day_of_week", "day_of_month", "month", "quarter", "year", "week_of_year", "is_weekend",
     "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_holiday", "is_holiday_es",
     "load_mw_clean_lag_1", "load_mw_clean_lag_24", "load_mw_clean_lag_48", "load_mw_clean_lag_168",
     "load_mw_clean_roll_mean_24", "load_mw_clean_roll_std_24", "load_mw_clean_roll_mean_168",
     "load_mw_clean_roll_std_168"])

DOUBLE_HINTS = ("load_mw", "_sin", "_cos", "_lag_", "_roll_", "q1", "q3", "iqr", "lower", "upper", "mape",
                "rmse", "mae", "mean", "std", "peak", "value", "score", "share", "stat", "avg")


def select_rounded(cols: list[str], doubles: set[str] | None = None, src: str = "") -> str:
    """SELECT list that rounds the double columns (by name hint or explicit)."""
    out = []
    for c in cols:
        is_d = (c in doubles) if doubles is not None else (
            any(h in c for h in DOUBLE_HINTS) and c not in ("quality_flag",))
        ref = f"{src}{c}"
        out.append(f"{rnd(ref)} AS {c}" if is_d else f"{ref} AS {c}")
    return ", ".join(out)
