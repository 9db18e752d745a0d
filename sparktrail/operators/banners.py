"""Banner (recommendation) revenue attribution (A12) and daily site totals
(A15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrail.operators.orders import order_revenue, session_revenue

N_BANNER_TYPES = 11
SESSION = ["web_id", "uuid", "session_id"]


def banner_revenue(purchase: DataFrame, clicks: DataFrame, grain=("date",), require_click_before: bool = False) -> DataFrame:
    """Per (grain, tenant, banner type 0..10): revenue and transactions
    of purchase sessions credited to the lowest-numbered type they clicked
    (priority waterfall), clicks = click rows, sessions = distinct
    (uuid, session_id); only (tenant, type) pairs with clicks are reported.

    ``grain`` columns must exist on both inputs (e.g. date, hour of the file).
    With ``require_click_before`` (Q27) each order is credited to the lowest type
    that its session clicked no later than the order; a session has at most
    ``N_BANNER_TYPES`` first clicks, which bounds the join.
    """
    g = list(grain)
    c = clicks.where(F.col("recommend_type").between(0, N_BANNER_TYPES - 1))
    stats = c.groupBy(*g, "web_id", "recommend_type").agg(
        F.count(F.lit(1)).alias("clicks"),
        F.count_distinct("uuid", "session_id").alias("sessions"))
    rev = order_revenue(purchase, key=[*g, *SESSION, "timestamp"])
    if require_click_before:
        first = c.groupBy(*g, *SESSION, "recommend_type").agg(F.min("timestamp").alias("_clicked"))
        sess = (rev.join(first, [*g, *SESSION]).where(F.col("_clicked") <= F.col("timestamp"))
                   .groupBy(*g, *SESSION, "timestamp")
                   .agg(F.min("recommend_type").alias("recommend_type"), F.max("revenue").alias("revenue"))
                   .groupBy(*g, *SESSION, "recommend_type").agg(F.sum("revenue").alias("revenue")))
    else:
        credit = c.groupBy(*g, *SESSION).agg(F.min("recommend_type").alias("recommend_type"))
        sess = session_revenue(rev, [*g, *SESSION]).join(credit, [*g, *SESSION])
    credited = (sess.groupBy(*g, "web_id", "recommend_type")
                    .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("transaction")))
    out = stats.join(credited, [*g, "web_id", "recommend_type"], "left")
    return out.select(*g, "web_id", F.col("recommend_type").cast("int").alias("recommend_type"),
                      F.coalesce(F.col("revenue"), F.lit(0)).cast("double").alias("revenue"),
                      F.col("clicks").cast("bigint").alias("clicks"),
                      F.col("sessions").cast("bigint").alias("sessions"),
                      F.coalesce(F.col("transaction"), F.lit(0)).cast("bigint").alias("transaction"))


def site_daily_totals(purchase: DataFrame, load: DataFrame) -> DataFrame:
    """Per (tenant, date): total order revenue and transactions (orders
    with ts in [date, date + 24h], inclusive as in the reference), joined
    to users / sessions of that date's load events; tenants come from the
    load statistics, missing totals -> 0."""
    from sparktrail.functions.dates import day_bucket
    day, mid = day_bucket(F.col("date_time"))
    days = F.when(mid, F.array(day, F.date_sub(day, 1))).otherwise(F.array(day))
    p = purchase.withColumn("date", F.explode(days))
    rev = order_revenue(p, key=["date", "web_id", "uuid", "session_id", "timestamp"])
    tot = rev.groupBy("date", "web_id").agg(F.sum("revenue").alias("total_revenue"),
                                           F.count(F.lit(1)).alias("transactions"))
    us = (load.withColumn("date", F.to_date("date_time"))
              .groupBy("date", "web_id", "uuid").agg(F.count_distinct("session_id").alias("_s"))
              .groupBy("date", "web_id").agg(F.count(F.lit(1)).alias("users"), F.sum("_s").alias("sessions")))
    return (us.join(tot, ["date", "web_id"], "left")
              .select("web_id", F.coalesce(F.col("total_revenue"), F.lit(0)).cast("double").alias("total_revenue"),
                      F.col("users").cast("bigint").alias("users"), F.col("sessions").cast("bigint").alias("sessions"),
                      F.coalesce(F.col("transactions"), F.lit(0)).cast("bigint").alias("transactions"), "date"))
