"""Ad campaign growth counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrail.functions.dates import day_bucket, in_window
from sparktrail.plans.sizing import maybe_broadcast


def ad_growth(accept_af: DataFrame, accept_ad: DataFrame, send_afad: DataFrame, ads: DataFrame) -> DataFrame:
    """Per ad campaign in [start, activity_end]: ``addfan_growth`` =
    distinct visitors of acceptAf, plus distinct visitors of acceptAd when
    ``ad_url = ad_btn_url`` (a visitor in both counts twice, as in the
    reference); ``addfan_impression`` = sendAfAd rows.

    ``ads``: ``activities(..., flag='ad_enable')`` with ad_url/ad_btn_url.
    """
    def bucket(df, kind):
        day, mid = day_bucket(F.col("date_time"))
        return (df.select("web_id", "ad_id", "uuid", day.alias("day"), mid.alias("mid"), F.lit(kind).alias("kind"))
                  .groupBy("web_id", "ad_id", "kind", "uuid", "day", "mid")
                  .agg(F.count(F.lit(1)).alias("n")))
    ev = bucket(accept_af, "af").unionByName(bucket(accept_ad, "ad")).unionByName(bucket(send_afad, "send"))
    cam = maybe_broadcast(ads.select(F.col("id").alias("ad_id"), "web_id", "activity_start", "activity_end",
                                     (F.col("ad_url") == F.col("ad_btn_url")).alias("same_url")))
    j = (ev.join(cam, ["web_id", "ad_id"])
           .where(in_window(F.col("day"), F.col("mid"), F.col("activity_start"), F.col("activity_end"))))
    per_kind = j.groupBy("ad_id", "kind", "uuid").agg(F.sum("n").alias("n"),
                                                      F.max("same_url").alias("same_url"))
    cnt = per_kind.groupBy("ad_id").agg(
        F.sum(F.when(F.col("kind") == "af", 1).when((F.col("kind") == "ad") & F.col("same_url"), 1)
               .otherwise(0)).alias("addfan_growth"),
        F.sum(F.when(F.col("kind") == "send", F.col("n")).otherwise(0)).alias("addfan_impression"))
    return (ads.select(F.col("id").alias("ad_id")).join(cnt, "ad_id", "left")
               .select(F.col("ad_id").alias("id"),
                       F.coalesce(F.col("addfan_growth"), F.lit(0)).cast("bigint").alias("addfan_growth"),
                       F.coalesce(F.col("addfan_impression"), F.lit(0)).cast("bigint").alias("addfan_impression")))
