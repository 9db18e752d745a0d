"""Batch-coupon release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrail.plans.sizing import maybe_broadcast

from sparktrail.functions.dates import lit_ts


def coupon_release(sent_codes: DataFrame, accept: DataFrame, batch_campaigns: DataFrame,
                   as_of, hold_hours: int = 2) -> DataFrame:
    """Codes of running batch campaigns marked sent more than
    ``hold_hours`` before ``as_of`` and never accepted -> ``is_sent = 0``.

    ``sent_codes``: addfan_coupon (web_id, link_code, coupon_code, is_sent,
    update_time); ``accept``: acceptCoupon rows with link_code, coupon_code;
    ``batch_campaigns``: ``activities(mode='running', code_modes=(1, 2))``.
    """
    cutoff = F.timestamp_add("HOUR", F.lit(-hold_hours), lit_ts(as_of))
    camp = maybe_broadcast(batch_campaigns.select("web_id", "link_code").distinct())
    sent = (sent_codes.where((F.col("is_sent") == 1) & (F.col("update_time") < cutoff))
                      .join(camp, ["web_id", "link_code"], "left_semi")
                      .select("web_id", "link_code", "coupon_code").distinct())
    acc = accept.select("web_id", "link_code", "coupon_code")
    return (sent.join(acc, ["web_id", "link_code", "coupon_code"], "left_anti")
                .withColumn("is_sent", F.lit(0)))


def mark_codes_sent(codes: DataFrame, sent: DataFrame) -> DataFrame:
    """``update_is_sent`` for a list of codes (web_id, link_code, coupon_code): ``is_sent = 1`` (a K03 update)."""
    from sparktrail.operators.upsert import update_rows
    keys = ["web_id", "link_code", "coupon_code"]
    return update_rows(codes, sent.select(*keys, F.lit(1).alias("is_sent")).distinct(), keys, ["is_sent"])


def mark_sent(codes: DataFrame, web_id: str, link_code: str, coupon_code: str) -> DataFrame:
    """``update_is_sent`` of one code."""
    hit = ((F.col("web_id") == web_id) & (F.col("link_code") == link_code)
           & (F.col("coupon_code") == coupon_code))
    return codes.withColumn("is_sent", F.when(hit, F.lit(1)).otherwise(F.col("is_sent")))
