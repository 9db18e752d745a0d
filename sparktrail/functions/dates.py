"""Date and time column functions.

All functions are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen. Wall-clock values are ``TIMESTAMP_NTZ``; epoch maths is
done against the NTZ epoch so results never depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_ts(value) -> Column:
    """Literal wall-clock timestamp (NTZ) from a str/date/datetime."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, str):
        value = to_datetime(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    # via text: a Python datetime literal would pass through the session zone
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def lit_date(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = to_datetime(value)
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(value)


def to_datetime(value, pattern: str | None = None) -> _dt.datetime:
    """Driver-side parameter parsing (C02): str/date/datetime -> datetime."""
    if isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    if pattern:
        return _dt.datetime.strptime(value, pattern)
    for fmt in ("%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d %H", "%Y-%m-%d"):
        try:
            return _dt.datetime.strptime(value, fmt)
        except ValueError:
            pass
    raise ValueError(f"unparsable datetime {value!r}")


def epoch_ms(ts) -> Column:
    """NTZ wall clock -> epoch milliseconds (BIGINT)."""
    us = F.timestamp_diff("MICROSECOND", _epoch(), col_(ts))
    return F.floor(us / F.lit(1000)).cast("bigint")


def ms_to_local(ms, utc_offset_hours: int = 8) -> Column:
    """Epoch ms -> wall clock at UTC+offset, as TIMESTAMP_NTZ."""
    base = F.timestamp_add("MILLISECOND", col_(ms).cast("bigint"), _epoch())
    return F.timestamp_add("HOUR", F.lit(utc_offset_hours), base)


def curdate(as_of, utc_offset_hours: int = 0) -> Column:
    """Midnight of ``as_of + utc`` hours (as_of is a UTC timestamp)."""
    return F.to_date(F.timestamp_add("HOUR", F.lit(utc_offset_hours), lit_ts(as_of)))


def date_shift(d, days: int) -> Column:
    """Date minus ``days``."""
    return F.date_sub(col_(d), days)


def days_of_month(d) -> Column:
    """C04."""
    return F.dayofmonth(F.last_day(col_(d)))


def date_to_int(d) -> Column:
    """2022-01-05 -> 20220105."""
    return F.date_format(col_(d), "yyyyMMdd").cast("int")


def datetime_to_str(ts, fmt: str = "yyyy-MM-dd") -> Column:
    """C05."""
    return F.date_format(col_(ts), fmt)


def date_range(spark, start, n_days: int):
    """``n_days`` consecutive dates from ``start`` (one-row spine exploded)."""
    s = lit_date(start)
    return spark.range(1).select(
        F.explode(F.sequence(s, F.date_add(s, n_days - 1))).alias("date"))


def datetime_range(spark, start, n_days: int, hour_sep: int):
    """Points every ``hour_sep`` hours; ``n_days*ceil(24/sep)+1`` points."""
    import math
    n = n_days * math.ceil(24 / hour_sep) + 1
    s = lit_ts(start)
    return (spark.range(n)
            .select(F.timestamp_add("HOUR", (F.col("id") * hour_sep).cast("int"), s).alias("date_time")))


def seconds_to_ts(sec) -> Column:
    """C08 timestamp_to_date: epoch seconds -> NTZ (UTC)."""
    return F.timestamp_add("SECOND", col_(sec).cast("bigint"), _epoch())


def ts_to_seconds(ts) -> Column:
    """C08 date_to_timestamp: NTZ -> epoch seconds."""
    return F.timestamp_diff("SECOND", _epoch(), col_(ts))


def day_bucket(ts) -> tuple[Column, Column]:
    """(day, is_midnight) of a timestamp: the two facts a date-bounded
    inclusive ``BETWEEN`` needs (see ``in_window``)."""
    c = col_(ts)
    day = F.to_date(c)
    return day, (c == day.cast("timestamp_ntz"))


def in_window(day, mid, lo, hi) -> Column:
    """Exact test of ``ts BETWEEN lo AND hi`` for midnight bounds, given the
    ts's (day, is_midnight) bucket. ``lo``/``hi`` are DATE columns; a NULL
    bound is open. A bucket of several rows is in the window when any row is.
    """
    lo_ok = F.when(lo.isNull(), F.lit(True)).otherwise(day >= lo)
    hi_ok = F.when(hi.isNull(), F.lit(True)).otherwise((day < hi) | ((day == hi) & mid))
    return lo_ok & hi_ok
