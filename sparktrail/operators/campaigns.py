"""Campaign (coupon activity) selections, unit cost, budget and alerts.

F09-F13 (selections, minimum spend), A06 (unit cost), A08 (remaining budget),
A24 (stale-coupon alert), F08/F14 (tenant settings lookups).

Campaign and settings tables are dimensions: one row per campaign / tenant.
They are joined to event facts with ``broadcast`` only after
``plans.sizing.broadcastable`` has bounded their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrail.functions.dates import lit_date, lit_ts
from sparktrail.functions.scalars import min_spend
from sparktrail.plans.sizing import maybe_broadcast

CAMPAIGN_COLUMNS = ["id", "web_id", "link_code", "coupon_type", "coupon_amount",
                    "activity_start", "activity_end", "coupon_total", "coupon_price_limit"]


def activities(campaigns: DataFrame, mode: str = "all", as_of=None, ids=None,
               flag: str = "coupon_enable", exclude_web_ids=(),
               code_modes=None) -> DataFrame:
    """campaign selection.

    mode: ``all`` | ``by_id`` (``ids``: a list, or a table with ``id``) | ``running`` | ``just_expired``. ``flag`` is the
    enable column (``coupon_enable`` for coupons, ``ad_enable`` for ads);
    ``code_modes`` restricts ``coupon_code_mode`` (batch coupons: (1, 2)).
    ``activity_end`` is ``end_time + 1 day`` as in the reference selection.
    """
    df = campaigns
    if exclude_web_ids:
        df = df.where(~F.col("web_id").isin(list(exclude_web_ids)))
    if mode == "by_id":
        if isinstance(ids, DataFrame):
            df = df.join(ids.select("id"), "id", "left_semi")
        else:
            df = df.where(F.col("id").isin(list(ids or [])))
    elif mode in ("running", "just_expired"):
        today = lit_date(as_of)
        enabled = (F.col("activity_enable") == 1) & (F.col(flag) == 1) & (F.col("activity_delete") == 0)
        if mode == "running":
            df = df.where(today.between(F.col("start_time"), F.col("end_time")) & enabled)
        else:
            df = df.where(F.to_date("update_time").between(F.col("start_time"), F.col("end_time"))
                          & F.datediff(today, F.col("end_time")).between(0, 1) & enabled)
    elif mode != "all":
        raise ValueError(f"unknown selection mode {mode}")
    if code_modes is not None:
        df = df.where(F.col("coupon_code_mode").isin(list(code_modes)))
    extra = [c for c in ("coupon_used", "ad_url", "ad_btn_url") if c in campaigns.columns]
    return df.select(
        "id", "web_id", "link_code", "coupon_type", "coupon_amount",
        F.col("start_time").alias("activity_start"),
        F.date_add("end_time", 1).alias("activity_end"),
        "coupon_total", min_spend(F.col("coupon_limit")).alias("coupon_price_limit"), *extra)


def upcoming_budget(campaigns: DataFrame, as_of, exclude_web_ids=()) -> DataFrame:
    """campaigns starting within 2 days or running, with
    ``avg_n_coupon = (total - used) / (1 + datediff(end, today))``."""
    today = lit_date(as_of)
    df = campaigns
    if exclude_web_ids:
        df = df.where(~F.col("web_id").isin(list(exclude_web_ids)))
    return (df.where((F.datediff("start_time", today) <= 2) & (today <= F.col("end_time"))
                     & (F.col("activity_enable") == 1) & (F.col("coupon_enable") == 1)
                     & (F.col("activity_delete") == 0))
            .select("id", "web_id",
                    F.try_divide((F.col("coupon_total") - F.col("coupon_used")).cast("double"),
                                 (1 + F.datediff("end_time", today)).cast("double")).alias("avg_n_coupon")))


def tenant_cells(settings: DataFrame, only_enabled: bool = True) -> DataFrame:
    """F14 ``fetch_calc_types``: (web_id, tt, cc) of analysis-enabled tenants."""
    df = settings.where(F.col("enable_analysis") == 1) if only_enabled else settings
    return df.select("web_id",
                     F.coalesce(F.col("type_total_price"), F.lit(0)).cast("int").alias("tt"),
                     F.coalesce(F.col("type_cal_cost"), F.lit(0)).cast("int").alias("cc"))


def unit_cost(campaigns: DataFrame, addfan_stat: DataFrame) -> DataFrame:
    """Coupon cost per use: type 1 -> tenant average shipping price,
    2 -> the amount, 3 -> -1 (percent-off, priced later), else 100."""
    stat = addfan_stat.select("web_id", F.col("avg_shipping_price").alias("_ship"))
    amount = F.floor(F.col("coupon_amount").try_cast("double")).cast("bigint")
    return (campaigns.join(maybe_broadcast(stat), "web_id", "left")
            .withColumn("unit_cost",
                        F.when(F.col("coupon_type") == 1, F.col("_ship").cast("bigint"))
                         .when(F.col("coupon_type") == 2, amount)
                         .when(F.col("coupon_type") == 3, F.lit(-1).cast("bigint"))
                         .otherwise(F.lit(100).cast("bigint")))
            .drop("_ship"))


def remaining_budget(df: DataFrame, as_of, utc_offset_hours: int = 0) -> DataFrame:
    """``avg_n_coupon = (coupon_total - coupon_used) / days_remain``,
    0 when no day remains; days from today to ``activity_end`` (may be < 0)."""
    today = lit_date(as_of)
    days = F.datediff(F.col("activity_end"), today)
    return df.withColumn("days_remain", days).withColumn(
        "avg_n_coupon",
        F.when(days == 0, F.lit(0.0))
         .otherwise((F.col("coupon_total") - F.col("coupon_used")).cast("double") / days.cast("double")))


def stale_coupons(campaigns: DataFrame, as_of, max_days: int = 10, exclude_web_ids=()) -> DataFrame:
    """Enabled, live, never-used coupons without an ad image whose start
    is more than n days ago; reports the largest such n in 1..max_days."""
    today = lit_date(as_of)
    n = F.least(F.lit(max_days), F.datediff(today, F.col("start_time")) - 1)
    df = campaigns
    if exclude_web_ids:
        df = df.where(~F.col("web_id").isin(list(exclude_web_ids)))
    return (df.where((F.col("ad_image_url") == "_") & (F.col("activity_delete") == 0)
                     & (F.col("coupon_enable") == 1) & (F.col("activity_enable") == 1)
                     & (F.col("end_time") > today) & (F.col("coupon_used") == 0) & (n >= 1))
            .select("id", "web_id", n.cast("int").alias("unused_days")))


def tenant_selection(settings: DataFrame, kind: str) -> DataFrame:
    """tenants with analysis enabled / addfan enabled / platform '91' /
    model missing."""
    if kind == "analysis":
        cond = F.col("enable_analysis") == 1
    elif kind == "addfan":
        cond = F.col("enable_addfan") == 1
    elif kind == "platform91":
        cond = F.col("platform") == "91"
    elif kind == "no_model":
        cond = F.col("model_value").isNull() | (F.col("model_value") == "_")
    else:
        raise ValueError(kind)
    return settings.where(cond).select("web_id")


def tenant_status(settings: DataFrame, web_id=None) -> DataFrame:
    """status projection of one / all tenants."""
    df = settings if web_id is None else settings.where(F.col("web_id") == web_id)
    return df.select("web_id", "enable_analysis", "enable_tracking", "enable_addfan", "platform")
