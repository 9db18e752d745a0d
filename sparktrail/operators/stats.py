"""Daily tracker statistics (A16), coupon statistics (A17) and their merge
(A18, J12).

Many exact distinct counts are computed without Spark's Expand: rows are
first reduced to (tenant, date, type, visitor, session), then to
(tenant, date, type, visitor), then pivoted with conditional sums - three
partial-aggregated shuffles whose sizes shrink at each step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKER_TYPES = ["load", "leave", "timeout", "addCart", "removeCart", "purchase"]
COUPON_TYPES = ["sendCoupon", "acceptCoupon", "discardCoupon"]


def _tagged(tables: dict[str, DataFrame], types, with_pb: bool) -> DataFrame:
    parts = []
    for t in types:
        df = tables[t]
        pb = F.col("is_purchased_before") if (with_pb and "is_purchased_before" in df.columns) else F.lit(0)
        parts.append(df.select("web_id", F.to_date("date_time").alias("date"), F.lit(t).alias("etype"),
                               "uuid", F.col("session_id").cast("string").alias("session_id"),
                               (pb == 1).cast("int").alias("pb")))
    return reduce(DataFrame.unionByName, parts)


def _visitor_level(tagged: DataFrame) -> DataFrame:
    return _visitors(tagged.groupBy("web_id", "date", "etype", "uuid", "session_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("pb").alias("pb")))


def _visitors(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("web_id", "date", "etype", "uuid").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("ns"), F.max("pb").alias("pb"))


def session_rows(clean: DataFrame, place: list[str]) -> DataFrame:
    """A clean table as rows (web_id, place, uuid, session_id, n, pb): what the statistics need of it, in a form that
    can be stored and added up."""
    pb = F.col("is_purchased_before") if "is_purchased_before" in clean.columns else F.lit(0)
    rows = clean.select("web_id", *place, "uuid", F.col("session_id").cast("string").alias("session_id"),
                        (pb == 1).cast("int").alias("pb"))
    return rows.groupBy("web_id", *place, "uuid", "session_id").agg(F.count(F.lit(1)).alias("n"), F.max("pb").alias("pb"))


def merged_statistics(sessions: DataFrame) -> DataFrame:
    """A18 from stored session rows (web_id, date, etype, uuid, session_id, n, pb), of which a session may have several."""
    whole = sessions.groupBy("web_id", "date", "etype", "uuid", "session_id").agg(
        F.sum("n").alias("n"), F.max("pb").alias("pb"))
    visitors = _visitors(whole)
    tracker, coupon = visitors.where(F.col("etype").isin(TRACKER_TYPES)), visitors.where(F.col("etype").isin(COUPON_TYPES))
    return _tracker_counts(tracker, "load").join(_coupon_counts(coupon), ["web_id", "date"], "full")


def tracker_statistics(tables: dict[str, DataFrame], tenants: str = "load") -> DataFrame:
    """Per (web_id, date): n_events / n_uuid / n_sessions for the six
    tracker event types, plus visitors with ``is_purchased_before = 1`` on
    load and on purchase. ``tenants='load'`` keeps only tenant-days with load
    events (as the reference); ``'any'`` keeps all."""
    return _tracker_counts(_visitor_level(_tagged(tables, TRACKER_TYPES, True)), tenants)


def _tracker_counts(v: DataFrame, tenants: str) -> DataFrame:
    aggs = []
    for t in TRACKER_TYPES:
        is_t = F.col("etype") == t
        aggs += [F.sum(F.when(is_t, F.col("n")).otherwise(0)).cast("bigint").alias(f"n_events_{t}"),
                 F.sum(F.when(is_t, 1).otherwise(0)).cast("bigint").alias(f"n_uuid_{t}"),
                 F.sum(F.when(is_t, F.col("ns")).otherwise(0)).cast("bigint").alias(f"n_sessions_{t}")]
    aggs += [F.sum(F.when((F.col("etype") == "load") & (F.col("pb") == 1), 1).otherwise(0)).cast("bigint")
             .alias("n_uuid_load_purchased_before"),
             F.sum(F.when((F.col("etype") == "purchase") & (F.col("pb") == 1), 1).otherwise(0)).cast("bigint")
             .alias("n_uuid_purchase_purchased_before")]
    out = v.groupBy("web_id", "date").agg(*aggs)
    if tenants == "load":
        out = out.where(F.col("n_events_load") > 0)
    return out


def coupon_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """Per (web_id, date): n_events / n_uuid of send, accept and
    discard coupon events; tenants = any with one of them."""
    return _coupon_counts(_visitor_level(_tagged(tables, COUPON_TYPES, False)))


def _coupon_counts(v: DataFrame) -> DataFrame:
    aggs = []
    for t in COUPON_TYPES:
        is_t = F.col("etype") == t
        aggs += [F.sum(F.when(is_t, F.col("n")).otherwise(0)).cast("bigint").alias(f"n_events_{t}"),
                 F.sum(F.when(is_t, 1).otherwise(0)).cast("bigint").alias(f"n_uuid_{t}")]
    return v.groupBy("web_id", "date").agg(*aggs)


def event_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """Full-outer merge of tracker and coupon statistics on
    (web_id, date) - the rows the reference upserts into its stat table."""
    return tracker_statistics(tables).join(coupon_statistics(tables), ["web_id", "date"], "full")
