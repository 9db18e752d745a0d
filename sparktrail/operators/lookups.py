"""Inspection lookups of raw and clean events."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrail.functions.dates import lit_ts, to_datetime


def local_events(raw: DataFrame, web_id: str, event_type: str, n: int = 1) -> DataFrame:
    """first ``n`` raw events of a tenant and type (ingest order)."""
    from sparktrail.sources.raw import criteria_filter
    return criteria_filter(raw, {"web_id": web_id, "event_type": event_type}).orderBy("ord").limit(n)


def hour_events(clean: DataFrame, date, hour: int, web_id: str, n: int = 1) -> DataFrame:
    """F16: clean events with ``date_time`` in [date hour:00, +1 hour]
    (inclusive, interval arithmetic so hour 23 rolls over), first ``n`` by
    ingest order."""
    start = to_datetime(date) + _dt.timedelta(hours=hour)
    end = start + _dt.timedelta(hours=1)
    return (clean.where(F.col("date_time").between(lit_ts(start), lit_ts(end)) & (F.col("web_id") == web_id))
                 .orderBy("ord").limit(n))


def latest_events(clean: DataFrame, web_id: str, n: int = 1, id_col: str = "ord") -> DataFrame:
    """The latest ``n`` rows of a tenant by id (TakeOrderedAndProject)."""
    return clean.where(F.col("web_id") == web_id).orderBy(F.col(id_col).desc()).limit(n)
