"""Coupon attribution: revenue, uses and cost per campaign (A01, A02, A05,
A07, A09-A11, A25, A26) - the reference's 12-cell SQL matrix as one plan.

A tenant's (type_total_price ``tt``, type_cal_cost ``cc``) choose the cell:

* orders: tt = 0 -> order groups ``(web_id, uuid, session_id, timestamp)``
  totalling ``price * qty``; tt != 0 -> purchase lines with ``total_price``.
* line filters: cc 1 -> ``coupon != 0`` (MySQL numeric coercion); cc 3 ->
  ``avivid_coupon = '1'``; daily, tt 0, cc 1-5 -> ``product_price > 0``.
* join keys accept x order: ``(web_id, uuid, session_id)``; cc 4 drops the
  session; cc 2 adds ``accept.coupon_code = purchase.coupon``; cc 4/5 also
  need an enterCoupon of the same visitor (and session for cc 5) and code.
* windows (inclusive, midnight bounds): see ``_lifetime_windows`` and
  ``_daily_windows``.
* each (campaign, visitor, order session) counts once with its earliest
  joined order (the reference's GROUP BY leaves the pick arbitrary).
* cost: cc 1 & tt 0 -> sum of per-order ``avg(abs(coupon))``; else uses x
  unit cost; coupon_type 3 -> ``floor(floor(revenue) * (10 - amount) / 10)``.

Plan shape: every event side is first reduced to (keys, day, is_midnight)
buckets - exact for date-bounded ``BETWEEN`` and bounded per key by the
number of days - then equi-joined on visitor keys. Campaign rows (a small,
size-checked dimension) are broadcast; there is no per-campaign loop, no
nested-loop join and no cross product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrail.functions.dates import day_bucket, in_window, lit_date
from sparktrail.functions.scalars import coupon_number
from sparktrail.plans.sizing import broadcast_if_bounded, maybe_broadcast

KEY = ["web_id", "uuid", "jsess", "jcode"]


def campaign_cells(campaigns: DataFrame, cells: DataFrame) -> DataFrame:
    """Attach the tenant cell; tenants without settings default to (0, 0)."""
    c = campaigns.join(cells.select("web_id", "tt", "cc"), "web_id", "left")
    return (c.withColumn("tt", F.coalesce(F.col("tt"), F.lit(0)))
             .withColumn("cc", F.coalesce(F.col("cc"), F.lit(0)))
             .withColumn("amount", F.col("coupon_amount").try_cast("double")))


def _lifetime_windows(s: Column, e: Column) -> dict[str, Column]:
    dated = (F.col("tt") == 0) | F.col("cc").isin(4, 5)
    lo = F.when(dated, s)
    hi = F.when(dated & (F.col("cc") != 4), e)
    return {"acc_lo": lo, "acc_hi": hi, "pur_lo": lo, "pur_hi": hi, "ent_lo": lo, "ent_hi": hi}


WINDOWINGS = ("reference", "dated")


def _undated(windowing: str) -> Column:
    """Cells whose daily query has no date filter at all (tt != 0, cc not 4/5); ``dated`` windowing has none."""
    if windowing not in WINDOWINGS:
        raise ValueError(f"windowing must be one of {WINDOWINGS}")
    return F.lit(False) if windowing == "dated" else (F.col("tt") != 0) & ~F.col("cc").isin(4, 5)


def _two_sided_daily(windowing: str) -> Column:
    """Daily cell whose accept window is [d, d+1] instead of >= d-1; with ``dated`` windowing for any tt."""
    return (F.col("cc") == 3) & (F.lit(windowing == "dated") | (F.col("tt") == 0))


def _tenant(df: DataFrame, cells: DataFrame) -> DataFrame:
    c = df.join(cells.select("web_id", "tt", "cc"), "web_id", "left")
    return c.withColumn("tt", F.coalesce(F.col("tt"), F.lit(0))).withColumn("cc", F.coalesce(F.col("cc"), F.lit(0)))


def _line_filter(daily: bool) -> Column:
    """The cell's filter on purchase lines."""
    keep = (((F.col("cc") != 1) | (coupon_number(F.col("coupon")) != 0))
            & ((F.col("cc") != 3) | (F.col("avivid_coupon") == "1")))
    return keep & (~((F.col("tt") == 0) & F.col("cc").isin(1, 2, 3, 4, 5)) | (F.col("product_price") > 0)) if daily else keep


def _order_values() -> list[Column]:
    """An order's total, coupon value and code, ordinal and time, from its lines."""
    return [F.when(F.col("tt") == 0, F.sum(F.col("product_price") * F.col("product_quantity")))
             .otherwise(F.max("total_price")).alias("total"),
            F.avg(F.abs(coupon_number(F.col("coupon")))).alias("coupon_val"),
            F.min_by("coupon", "ord").alias("coupon_text"),
            F.min("ord").alias("ord"), F.min("date_time").alias("o_dt")]


def _order_keys(o: DataFrame) -> DataFrame:
    day, mid = day_bucket(F.col("o_dt"))
    return (o.withColumn("jsess", F.when(F.col("cc") == 4, F.lit("")).otherwise(F.col("session_id")))
             .withColumn("jcode", F.when(F.col("cc") == 2, F.col("coupon_text").cast("string")).otherwise(F.lit("")))
             .withColumn("o_day", day).withColumn("o_mid", mid))


def _line() -> Column:
    """What tells the order rows of a time apart: nothing for order groups (tt = 0), the line otherwise."""
    return F.when(F.col("tt") == 0, F.lit(-1).cast("bigint")).otherwise(F.col("ord").cast("bigint")).alias("_line")


def order_rows(purchase: DataFrame, cells: DataFrame, daily: bool = False) -> DataFrame:
    """A03 for all tenants at once: order groups (tt = 0) or lines (tt != 0),
    after the cell's line filters; one row per order candidate."""
    p = _tenant(purchase, cells).where(_line_filter(daily))
    o = p.groupBy("web_id", "uuid", "session_id", "timestamp", _line(), "tt", "cc").agg(*_order_values())
    return _order_keys(o).drop("_line")


def _bucket(df: DataFrame, keys: list[str], ts: str = "date_time") -> DataFrame:
    day, mid = day_bucket(F.col(ts))
    return (df.select(*keys, day.alias("day"), mid.alias("mid"))
              .groupBy(*keys, "day").agg(F.bool_or("mid").alias("mid")))


def _join_keys(df: DataFrame) -> DataFrame:
    """The session and code that a tenant's cell joins by (constants where it doesn't)."""
    return (df.withColumn("jsess", F.when(F.col("cc") == 4, F.lit("")).otherwise(F.col("session_id")))
              .withColumn("jcode", F.when(F.col("cc") == 2, F.col("coupon_code")).otherwise(F.lit(""))))


def _accept_keys(accept, enter, camp, cells) -> DataFrame:
    """Qualifying (campaign, visitor[, session][, code]) keys of the lifetime windows."""
    acc = _bucket(accept, ["web_id", "coupon_id", "uuid", "session_id", "coupon_code"])
    cam = camp.select(F.col("id").alias("coupon_id"), "web_id", "tt", "cc", "acc_lo", "acc_hi", "ent_lo", "ent_hi")
    ak = acc.join(cam, ["web_id", "coupon_id"])
    ak = _join_keys(ak.where(in_window(F.col("day"), F.col("mid"), F.col("acc_lo"), F.col("acc_hi"))))
    plain = ak.where(~F.col("cc").isin(4, 5))

    ent = _tenant(enter, cells).where(F.col("cc").isin(4, 5))
    ent = ent.withColumn("jsess", F.when(F.col("cc") == 4, F.lit("")).otherwise(F.col("session_id")))
    ek = (_bucket(ent, ["web_id", "uuid", "jsess", "coupon_code"])
          .withColumnRenamed("day", "e_day").withColumnRenamed("mid", "e_mid"))
    paired = ak.where(F.col("cc").isin(4, 5)).join(ek, ["web_id", "uuid", "jsess", "coupon_code"])
    paired = paired.where(in_window(F.col("e_day"), F.col("e_mid"), F.col("ent_lo"), F.col("ent_hi")))
    return plain.select("coupon_id", *KEY).unionByName(paired.select("coupon_id", *KEY)).distinct()


def _pick_and_sum(j: DataFrame, grain: list[str]) -> DataFrame:
    """Earliest joined order per (campaign[, day], visitor, order session),
    then campaign sums."""
    first = (j.groupBy(*grain, "uuid", "session_id")
              .agg(F.min_by(F.struct("total", "coupon_val"), F.struct("timestamp", "ord")).alias("o")))
    return (first.groupBy(*grain)
                 .agg(F.sum("o.total").alias("revenue"),
                      F.count("o.total").alias("coupon_used"),
                      F.sum("o.coupon_val").alias("coupon_sum")))


def _cost(revenue: Column, used: Column, coupon_sum: Column) -> Column:
    base = F.when((F.col("tt") == 0) & (F.col("cc") == 1), coupon_sum).otherwise(used * F.col("unit_cost"))
    pct = F.floor(F.floor(revenue) * (F.lit(10.0) - F.col("amount")) / F.lit(10.0))
    return F.when(F.col("coupon_type") == 3, pct.cast("double")).otherwise(base.cast("double"))


def lifetime_used(accept, purchase, enter, camp, cells) -> DataFrame:
    """A01 core: (coupon_id, revenue, coupon_used, coupon_sum) of campaigns
    with at least one attributed order. ``camp`` = campaign_cells output."""
    camp = camp.select("*", *[v.alias(k) for k, v in
                              _lifetime_windows(F.col("activity_start"), F.col("activity_end")).items()])
    qk = _accept_keys(accept, enter, camp, cells)
    o = order_rows(purchase, cells)
    cam = camp.select(F.col("id").alias("coupon_id"), "pur_lo", "pur_hi", "coupon_price_limit")
    j = (o.join(qk, KEY)
          .join(cam, "coupon_id")
          .where(in_window(F.col("o_day"), F.col("o_mid"), F.col("pur_lo"), F.col("pur_hi"))
                 & (F.col("total") > F.col("coupon_price_limit"))))
    return _pick_and_sum(j, ["coupon_id"])


def roas_lifetime(accept, purchase, enter, campaigns, cells, addfan_stat) -> DataFrame:
    """A01 + A05 + A06: per campaign revenue, cost and coupon_used.

    ``campaigns`` is an ``activities()`` selection; ``cells`` is
    ``tenant_cells(settings)``.
    """
    from sparktrail.operators.campaigns import unit_cost
    # one row per tenant and per campaign: hints only where the dimension is proven small
    cells = maybe_broadcast(cells)
    camp = broadcast_if_bounded(campaign_cells(unit_cost(campaigns, addfan_stat), cells), campaigns)
    used = lifetime_used(accept, purchase, enter, camp, cells)
    r = camp.drop("coupon_used").join(used.withColumnRenamed("coupon_id", "id"), "id", "left")
    revenue = F.coalesce(F.col("revenue"), F.lit(0))
    used_n = F.coalesce(F.col("coupon_used"), F.lit(0))
    csum = F.coalesce(F.col("coupon_sum"), F.lit(0.0))
    return r.select(F.col("id").alias("coupon_id"), "web_id",
                    revenue.cast("double").alias("revenue"),
                    _cost(revenue, used_n, csum).alias("cost"),
                    used_n.cast("bigint").alias("coupon_used"))


def spine(camp: DataFrame, as_of) -> DataFrame:
    """One row per campaign day, from start to min(activity_end, today)."""
    end = F.least(F.col("activity_end"), lit_date(as_of))
    return (camp.where(F.col("activity_start") <= end)
                .select("*", F.explode(F.sequence(F.col("activity_start"), end)).alias("d"),
                        end.alias("spine_end")))


ROLES = ("accept", "discard", "enter", "purchase")


def tag_events(accept: DataFrame, discard: DataFrame, enter: DataFrame, purchase: DataFrame) -> DataFrame:
    """The tables of the daily matrix as one, with their ``role``; an adapter that has them in one table tags it instead."""
    who = ["web_id", "uuid", "session_id", "date_time"]
    parts = [accept.select(*who, "coupon_id", "coupon_code"), discard.select(*who, "coupon_id"),
             enter.select(*who, "coupon_code"),
             purchase.select(*who, "ord", "timestamp", "coupon", "avivid_coupon", "product_price", "product_quantity",
                             "total_price")]
    out = None
    for role, part in zip(ROLES, parts):
        part = part.withColumn("role", F.lit(role))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def daily_buckets(tagged: DataFrame, cells: DataFrame) -> DataFrame:
    """All that the daily matrix needs of the events, in one pass over them: a row per (role, visitor, session,
    campaign, code, day) of visits, with whether one was at midnight, and per order candidate of purchases (A03)."""
    order = F.col("role") == "purchase"
    visit = lambda c: F.when(~order, F.col(c)).alias(c)
    day, mid = day_bucket(F.col("date_time"))
    t = _tenant(tagged, cells).where(~order | _line_filter(daily=True))
    return (t.groupBy("role", "web_id", "uuid", "session_id", "tt", "cc", visit("coupon_id"), visit("coupon_code"),
                      F.when(~order, day).alias("day"), F.when(order, F.col("timestamp")).alias("timestamp"),
                      F.when(order, _line()).alias("_line"))
            .agg(F.bool_or(mid).alias("mid"), *_order_values()))


def _daily_keys(visits: DataFrame, camp: DataFrame, windowing: str) -> DataFrame:
    """(campaign, visitor[, session][, code]) of accepts, with the day facts of the windows: each day for a two-sided
    window, else the latest day; cells without dates have any."""
    cam = camp.select(F.col("id").alias("coupon_id"), "web_id", "activity_start", _undated(windowing).alias("undated"),
                      _two_sided_daily(windowing).alias("two"))
    ak = _join_keys(visits.where("role = 'accept'").join(cam, ["web_id", "coupon_id"]).where(
        F.col("undated") | (F.col("day") >= F.date_sub("activity_start", 1))))
    entered = F.col("cc").isin(4, 5)
    ent = visits.where((F.col("role") == "enter") & entered).select(
        "web_id", "uuid", F.when(F.col("cc") == 4, F.lit("")).otherwise(F.col("session_id")).alias("jsess"), "coupon_code",
        F.col("day").alias("e_day"))
    # an accept counts up to the earlier of its day and the entry's: of a key's entries the last is enough
    paired = ak.where(entered).join(ent, ["web_id", "uuid", "jsess", "coupon_code"]).withColumn(
        "day", F.least("day", "e_day")).withColumn("mid", F.lit(False))
    cols = ["coupon_id", *KEY, "two", "day", "mid"]
    both = ak.where(~entered).select(*cols).unionByName(paired.select(*cols))
    return both.groupBy("coupon_id", *KEY, F.when(F.col("two"), F.col("day")).alias("_day")).agg(
        F.max("day").alias("day"), F.bool_or("mid").alias("mid")).drop("_day")


def _daily_used(buckets: DataFrame, camp: DataFrame, windowing: str) -> DataFrame:
    """A02 core for all cells at once: (coupon_id, d, revenue, coupon_used, coupon_sum), d null for cells without dates."""
    qk = _daily_keys(buckets, camp, windowing)
    days = F.when(F.col("o_mid"), F.array(F.col("o_day"), F.date_sub("o_day", 1))).otherwise(F.array(F.col("o_day")))
    o = _order_keys(buckets.where("role = 'purchase'").drop("day", "mid", "coupon_id", "coupon_code"))
    o = o.withColumn("d", F.explode(F.when(_undated(windowing), F.array(F.lit(None).cast("date"))).otherwise(days)))
    cam = camp.select(F.col("id").alias("coupon_id"), "coupon_price_limit", "activity_start", "spine_end",
                      _two_sided_daily(windowing).alias("two"))
    near = F.when(F.col("two"), in_window(F.col("day"), F.col("mid"), F.col("d"), F.date_add("d", 1))).otherwise(
        F.col("day") >= F.date_sub("d", 1))
    j = o.join(qk, KEY).join(cam, "coupon_id").where(
        (F.col("d").isNull() | (F.col("d").between(F.col("activity_start"), F.col("spine_end")) & near))
        & (F.col("total") > F.col("coupon_price_limit")))
    return _pick_and_sum(j, ["coupon_id", "d"])


def _daily_reach(visits: DataFrame, camp: DataFrame) -> DataFrame:
    """(coupon_id, d, coupon_accepted, coupon_imp); either is 0 where only the other is."""
    cam = camp.select(F.col("id").alias("coupon_id"), "web_id", "activity_start", "spine_end")
    v = visits.where(F.col("role").isin("accept", "discard")).join(cam, ["web_id", "coupon_id"])
    own = F.struct(F.col("day").alias("d"), F.lit(True).alias("own"))
    before = F.struct(F.date_sub("day", 1).alias("d"), F.lit(False).alias("own"))  # midnight ends the day before
    at = F.explode(F.when(F.col("mid"), F.array(own, before)).otherwise(F.array(own))).alias("at")
    v = v.select("coupon_id", "uuid", "role", "day", "mid", "activity_start", "spine_end", at)
    acc = F.col("at.own") & (F.col("role") == "accept") & in_window(
        F.col("day"), F.col("mid"), F.col("activity_start"), F.date_add("spine_end", 1))
    imp = F.col("at.d").between(F.col("activity_start"), F.col("spine_end"))
    seen = (v.select("coupon_id", "uuid", F.col("at.d").alias("d"), acc.cast("int").alias("acc"), imp.cast("int").alias("imp"))
            .where("acc + imp > 0").groupBy("coupon_id", "d", "uuid").agg(F.max("acc").alias("acc"), F.max("imp").alias("imp")))
    return seen.groupBy("coupon_id", "d").agg(F.sum("acc").alias("coupon_accepted"), F.sum("imp").alias("coupon_imp"))


def daily_reach(accept, discard, sp: DataFrame) -> DataFrame:
    """Per (campaign, date): coupon_accepted = distinct accepting
    visitors on that date within [start, spine_end + 1]; coupon_imp =
    distinct visitors of accept UNION discard with ts in [d, d + 1]."""
    day, mid = day_bucket(F.col("date_time"))
    visits = [df.select("web_id", "coupon_id", "uuid", F.lit(role).alias("role"), day.alias("day"), mid.alias("mid"))
              for role, df in (("accept", accept), ("discard", discard))]
    camp = maybe_broadcast(sp.select("id", "web_id", "activity_start", "spine_end").distinct())
    both = _daily_reach(visits[0].unionByName(visits[1]), camp)
    return (both.where("coupon_accepted > 0").select("coupon_id", "d", "coupon_accepted"),
            both.where("coupon_imp > 0").select("coupon_id", "d", "coupon_imp"))


def on_day(campaigns: DataFrame, date) -> DataFrame:
    """A26 "today only": campaigns cut to the one day, for ``roas_daily`` with ``as_of=date``."""
    return campaigns.where(F.col("activity_end") >= lit_date(date)).withColumn("activity_start", lit_date(date))


def roas_daily(accept, discard, purchase, enter, campaigns, cells, addfan_stat, as_of,
               windowing: str = "reference", complete_only: bool = False) -> DataFrame:
    """``roas_daily_tagged`` over tables of their own."""
    return roas_daily_tagged(tag_events(accept, discard, enter, purchase), campaigns, cells, addfan_stat, as_of,
                             windowing, complete_only)


def roas_daily_tagged(tagged: DataFrame, campaigns, cells, addfan_stat, as_of, windowing: str = "reference",
                      complete_only: bool = False) -> DataFrame:
    """A25/A26 daily table: per (coupon_id, date_time) coupon_accepted,
    coupon_imp, coupon_used, revenue, cost (integers, as stored).

    ``campaigns`` is any selection: all, running ones cut to a day (``on_day``),
    or single ids. ``windowing="dated"`` gives the cells without date filters
    the windows of tt = 0 (Q9). ``complete_only`` drops days that lack accepts,
    impressions or uses (J10).

    The events are read once, into buckets that are written once; dated and
    undated cells, accepts, entries and orders are all taken from these."""
    from sparktrail.operators.campaigns import unit_cost
    from sparktrail.plans.materialize import materialize
    cells = maybe_broadcast(cells)
    camp = campaign_cells(unit_cost(campaigns, addfan_stat), cells).withColumn(
        "spine_end", F.least("activity_end", lit_date(as_of))).where("activity_start <= spine_end")
    camp = broadcast_if_bounded(camp, campaigns)
    buckets = materialize(daily_buckets(tagged, cells))
    days = F.explode(F.sequence("activity_start", "spine_end")).alias("d")
    spine_days = camp.select(F.col("id").alias("coupon_id"), days)
    used = _daily_used(buckets, camp, windowing)
    if windowing == "reference":
        spread = camp.where(_undated(windowing)).select(F.col("id").alias("coupon_id"), "activity_start", "spine_end")
        lasting = used.where(F.col("d").isNull()).drop("d").join(spread, "coupon_id").select(
            "coupon_id", days, "revenue", "coupon_used", "coupon_sum")
        used = used.where(F.col("d").isNotNull()).unionByName(lasting)
    parts = [spine_days.withColumn("in_spine", F.lit(True)), used.withColumn("in_used", F.lit(True)),
             _daily_reach(buckets, camp)]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    sums = ["revenue", "coupon_used", "coupon_sum", "coupon_accepted", "coupon_imp"]
    r = stacked.groupBy("coupon_id", "d").agg(*[F.sum(c).alias(c) for c in sums], F.bool_or("in_spine").alias("in_spine"),
                                              F.bool_or("in_used").alias("in_used"))
    r = r.where("in_spine OR coupon_accepted > 0")
    if complete_only:
        r = r.where("in_used AND coupon_accepted > 0 AND coupon_imp > 0")
    info = camp.select(F.col("id").alias("coupon_id"), "web_id", "tt", "cc", "coupon_type", "amount", "unit_cost")
    r = r.join(info, "coupon_id")
    revenue = F.coalesce(F.col("revenue"), F.lit(0))
    used_n = F.coalesce(F.col("coupon_used"), F.lit(0))
    csum = F.coalesce(F.col("coupon_sum"), F.lit(0.0))
    return r.select(
        "coupon_id", "web_id", F.col("d").alias("date_time"),
        F.coalesce(F.col("coupon_accepted"), F.lit(0)).cast("bigint").alias("coupon_accepted"),
        F.coalesce(F.col("coupon_imp"), F.lit(0)).cast("bigint").alias("coupon_imp"),
        used_n.cast("bigint").alias("coupon_used"),
        F.floor(revenue).cast("bigint").alias("revenue"),
        F.floor(_cost(revenue, used_n, csum)).cast("bigint").alias("cost"))


def coupon_reach(send, accept, discard, campaigns) -> DataFrame:
    """Per campaign distinct visitors sent / accepted / shown
    (impression = accept UNION discard) within [start, activity_end].

    Two-level aggregation (visitor flags, then counts) instead of three
    COUNT(DISTINCT) - no Expand of the fact rows."""
    def b(df, kind):
        day, mid = day_bucket(F.col("date_time"))
        return (df.select("coupon_id", "uuid", day.alias("day"), mid.alias("mid"), F.lit(kind).alias("kind"))
                  .groupBy("coupon_id", "uuid", "kind", "day").agg(F.bool_or("mid").alias("mid")))
    ev = b(send, "s").unionByName(b(accept, "a")).unionByName(b(discard, "d"))
    cam = maybe_broadcast(campaigns.select(F.col("id").alias("coupon_id"), "activity_start", "activity_end"))
    v = (ev.join(cam, "coupon_id")
           .where(in_window(F.col("day"), F.col("mid"), F.col("activity_start"), F.col("activity_end")))
           .groupBy("coupon_id", "uuid")
           .agg(F.max((F.col("kind") == "s").cast("int")).alias("s"),
                F.max((F.col("kind") == "a").cast("int")).alias("a"),
                F.max(F.col("kind").isin("a", "d").cast("int")).alias("i")))
    cnt = v.groupBy("coupon_id").agg(F.sum("s").alias("coupon_sent"), F.sum("a").alias("coupon_accept"),
                                      F.sum("i").alias("coupon_impression"))
    return (campaigns.select(F.col("id").alias("coupon_id")).join(cnt, "coupon_id", "left")
            .select("coupon_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                    for c in ("coupon_sent", "coupon_accept", "coupon_impression")]))


def campaign_assembly(send, accept, discard, purchase, enter, campaigns, cells, addfan_stat, as_of) -> DataFrame:
    """ROAS + reach + remaining budget (A08, from the attributed uses)."""
    from sparktrail.operators.campaigns import remaining_budget
    roas = roas_lifetime(accept, purchase, enter, campaigns, cells, addfan_stat)
    reach = coupon_reach(send, accept, discard, campaigns)
    base = campaigns.select(F.col("id").alias("coupon_id"), "coupon_total", "activity_end")
    r = remaining_budget(roas.join(reach, "coupon_id").join(base, "coupon_id"), as_of)
    return r.select("coupon_id", "web_id", "revenue", "cost", "coupon_sent", "coupon_impression",
                    "coupon_accept", "coupon_used", "avg_n_coupon")


def rollup_daily(daily: DataFrame, coupon_ids=None) -> DataFrame:
    """A10: sums of the daily table by coupon (web_id: any of the rows)."""
    d = daily if coupon_ids is None else daily.where(F.col("coupon_id").isin(list(coupon_ids)))
    return d.groupBy("coupon_id").agg(
        F.min("web_id").alias("web_id"),
        F.sum("coupon_imp").cast("bigint").alias("coupon_impression"),
        F.sum("coupon_accepted").cast("bigint").alias("coupon_accept"),
        F.sum("coupon_used").cast("bigint").alias("coupon_used"),
        F.sum("cost").cast("bigint").alias("cost"),
        F.sum("revenue").cast("bigint").alias("revenue"))
