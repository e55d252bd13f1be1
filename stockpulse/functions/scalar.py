"""Null-safe arithmetic, defaults, dates and JSON as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: month*100+day of the holidays used by the derived calendar.
HOLIDAYS = (101, 126, 815, 1002, 1225)
#: Region to weather-station city.
REGION_CITY = {
    "Punjab": "Chandigarh", "Maharashtra": "Mumbai", "Karnataka": "Bengaluru",
    "Delhi NCR": "Delhi", "Tamil Nadu": "Chennai",
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """num / den as double, null when the denominator is zero or null."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct(num, den) -> Column:
    return ratio(num, den) * F.lit(100.0)


def or_default(c, default) -> Column:
    """Default for null *and zero* values."""
    c = _c(c)
    return F.when(c.isNull() | (c == 0), F.lit(default) if not isinstance(default, Column) else default).otherwise(c)


def abs_pct_error(actual, predicted) -> Column:
    """|a-p| / a * 100, null where the actual is zero."""
    return F.abs(_c(actual).cast("double") - _c(predicted).cast("double")) / F.nullif(
        _c(actual).cast("double"), F.lit(0.0)) * 100.0


def floor_zero(c) -> Column:
    return F.greatest(F.lit(0.0), _c(c))


def day_of_week(date) -> Column:
    """0 = Monday."""
    return F.weekday(_c(date))


def is_holiday(date) -> Column:
    return (F.month(_c(date)) * 100 + F.dayofmonth(_c(date))).isin(*HOLIDAYS)


def date_text(date) -> Column:
    return F.date_format(_c(date), "yyyy-MM-dd")


def month_key(date) -> Column:
    """Partition value of the monthly tables, for example 2024-01."""
    return F.date_format(_c(date), "yyyy-MM")


def future_dates(last_date, horizon: int) -> Column:
    """Array of the ``horizon`` days after a date."""
    return F.sequence(F.date_add(_c(last_date), 1), F.date_add(_c(last_date), horizon))


def weather_score(temp_kelvin) -> Column:
    return F.round((_c(temp_kelvin) - 295) / 10, 2)


def lookup(key, mapping: dict, default=None) -> Column:
    """Small fixed dictionary as an expression."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.element_at(table, _c(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def region_city(region) -> Column:
    return lookup(region, REGION_CITY)


def to_event_json(*cols) -> Column:
    """JSON payload; timestamps keep their microseconds."""
    return F.to_json(F.struct(*cols), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def from_event_json(value, schema: str) -> Column:
    return F.from_json(_c(value), schema)


def optional_equals(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters for the arguments that are set; None means no filter."""
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


#: Partition column of the monthly tables.
MONTH_PARTITION = "part_month"


def as_day(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def from_day(df: DataFrame, first: dt.date, column: str = "date") -> DataFrame:
    """Rows from a day on. A monthly table is also filtered on its partition column, so that whole
    months are pruned before any file is opened."""
    if MONTH_PARTITION in df.columns:
        df = df.filter(F.col(MONTH_PARTITION) >= first.strftime("%Y-%m"))
    return df.filter(F.col(column) >= F.lit(first))


def trailing(df: DataFrame, as_of, days: int, column: str = "date") -> DataFrame:
    """Rows with ``column >= as_of - days``; the bound is a literal, so the scan can prune."""
    return from_day(df, as_day(as_of) - dt.timedelta(days=days), column)


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add the absent columns with a constant."""
    missing = {n: F.lit(v) for n, v in defaults.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def pick_columns(df: DataFrame, requested, allowed, aliases=None) -> list[str]:
    """Requested names (after alias mapping) that exist; all allowed ones when none does."""
    aliases = aliases or {}
    chosen = [n for n in dict.fromkeys(aliases.get(r.strip(), r.strip()) for r in requested or []) if n in allowed]
    chosen = [n for n in chosen if n in df.columns]
    return chosen or [n for n in allowed if n in df.columns]
