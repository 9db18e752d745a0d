"""Registered queries (``queries()``) and their DuckDB twins (``oracle_sql()``).

Each query takes (spark, sf_dir) and returns a DataFrame over the driver
tables (through ``plans.adapters``); its oracle is independent SQL over the
same parquet tables. Column names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparktrail.operators import attribution as ATT
from sparktrail.plans import adapters as A
from sparktrail.plans import oracle as O
from sparktrail.plans.context import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _uniform(tt: int, cc: int) -> dict[str, tuple[int, int]]:
    return {f"w{t}": (tt, cc) for t in range(A.N_TENANTS)}


# ------------------------------------------------------------ ROAS matrix
def _roas_lifetime(cells_map):
    def q(spark, sf_dir):
        t = Tables(spark, sf_dir, cells_map)
        return ATT.roas_lifetime(t.accept, t.purchase, t.enter, t.activities("all"), t.cells, t.addfan_stat)
    return q


def _roas_daily(cells_map, select=lambda t: t.activities("all"), **options):
    def q(spark, sf_dir):
        t = Tables(spark, sf_dir, cells_map)
        return ATT.roas_daily_tagged(t.tagged, select(t), t.cells, t.addfan_stat, A.AS_OF, **options)
    return q


for _tt in (0, 1):
    for _cc in range(6):
        register(f"roas_lifetime_tt{_tt}_cc{_cc}", O.roas_lifetime_sql(_uniform(_tt, _cc)))(
            _roas_lifetime(_uniform(_tt, _cc)))
        register(f"roas_daily_tt{_tt}_cc{_cc}", O.roas_daily_sql(_uniform(_tt, _cc)))(
            _roas_daily(_uniform(_tt, _cc)))

register("roas_lifetime_mixed", O.roas_lifetime_sql(A.MIXED_CELLS))(_roas_lifetime(A.MIXED_CELLS))
register("roas_daily_mixed", O.roas_daily_sql(A.MIXED_CELLS))(_roas_daily(A.MIXED_CELLS))
_DATED = {f"w{i}": (1, cc) for i, cc in enumerate((0, 1, 2, 3, 5))}
# Q9: all cells by date; J10: only days with accepts, impressions and uses
register("roas_daily_dated", O.roas_daily_sql(_DATED, "dated"))(_roas_daily(_DATED, windowing="dated"))
register("roas_daily_complete", "SELECT * FROM (" + O.roas_daily_sql(A.MIXED_CELLS)
         + ") WHERE coupon_accepted > 0 AND coupon_imp > 0 AND coupon_used > 0")(
    _roas_daily(A.MIXED_CELLS, complete_only=True))


def _today(t: Tables) -> DataFrame:
    return ATT.on_day(t.activities("running"), A.AS_OF)


def _most_accepted(t: Tables) -> DataFrame:
    """The campaign of each tenant that most accepted coupons are of."""
    from pyspark.sql import functions as F
    n = t.accept.groupBy("web_id", "coupon_id").agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy("web_id").agg(F.max(F.struct("n", "coupon_id")).alias("b")).select(F.col("b.coupon_id").alias("id"))
    return t.activities("by_id", ids=best)


# Today only, and single campaigns
register("roas_daily_today", O.roas_daily_sql(A.MIXED_CELLS).replace(
    "start_time AS activity_start", f"{O.AS_OF_DATE} AS activity_start").replace(
    "     FROM campaigns)", f"     FROM campaigns WHERE {O.AS_OF_DATE} BETWEEN start_time AND end_time "
    "AND activity_enable = 1 AND coupon_enable = 1 AND activity_delete = 0)"))(_roas_daily(A.MIXED_CELLS, _today))
register("roas_daily_by_id", "SELECT * FROM (" + O.roas_daily_sql(A.MIXED_CELLS) + ") WHERE coupon_id IN (" + O.prefix()
         + "SELECT arg_max(coupon_id, (n, coupon_id)) FROM (SELECT web_id, coupon_id, COUNT(*) AS n FROM accept "
           "GROUP BY ALL) GROUP BY web_id)")(_roas_daily(A.MIXED_CELLS, _most_accepted))


# ------------------------------------------------------ campaign queries
from pyspark.sql import functions as F  # noqa: E402

from sparktrail.operators import ads as ADS  # noqa: E402
from sparktrail.operators import banners as BAN  # noqa: E402
from sparktrail.operators import campaigns as CAMP  # noqa: E402
from sparktrail.operators import coupons as CPN  # noqa: E402
from sparktrail.operators import orders as ORD  # noqa: E402
from sparktrail.operators import stats as ST  # noqa: E402

_P = O.prefix(None, [O.ACTIVITY, O.CAMP])
_PM = O.prefix(A.MIXED_CELLS, [O.ACTIVITY, O.CAMP])
_ASOF = O.AS_OF_DATE
# campaigns of all parts, tenants of all suppliers
_D = "WITH " + ",\n".join([A.dimension_sql(), O.ACTIVITY, O.CAMP])


def _part_activities(spark, sf_dir, mode="all", **kw):
    return CAMP.activities(A.part_campaigns(spark, sf_dir), mode, as_of=A.AS_OF, **kw)


@register("roas_rollup", O.roas_daily_sql(A.MIXED_CELLS).replace(
    "\n    SELECT g.coupon_id, c.web_id, g.d AS date_time,", "\n    , daily AS (SELECT g.coupon_id, c.web_id, g.d AS date_time,", 1)
    + """)
    SELECT coupon_id, MIN(web_id) AS web_id, CAST(SUM(coupon_imp) AS BIGINT) AS coupon_impression,
      CAST(SUM(coupon_accepted) AS BIGINT) AS coupon_accept, CAST(SUM(coupon_used) AS BIGINT) AS coupon_used,
      CAST(SUM(cost) AS BIGINT) AS cost, CAST(SUM(revenue) AS BIGINT) AS revenue
    FROM daily GROUP BY coupon_id""")
def q_roas_rollup(spark, sf_dir):
    """A10 over the A26 daily table of all campaigns."""
    return ATT.rollup_daily(_roas_daily(A.MIXED_CELLS)(spark, sf_dir))


@register("coupon_reach", _P + f"""
SELECT c.id AS coupon_id,
  CAST((SELECT COUNT(DISTINCT s.uuid) FROM send s WHERE s.coupon_id = c.id
        AND s.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) AS BIGINT) AS coupon_sent,
  CAST((SELECT COUNT(DISTINCT a.uuid) FROM accept a WHERE a.coupon_id = c.id
        AND a.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) AS BIGINT) AS coupon_accept,
  CAST((SELECT COUNT(*) FROM (SELECT a.uuid FROM accept a WHERE a.coupon_id = c.id
        AND a.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)
        UNION SELECT d.uuid FROM discard d WHERE d.coupon_id = c.id
        AND d.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) x) AS BIGINT) AS coupon_impression
FROM act c""")
def q_coupon_reach(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ATT.coupon_reach(t.send, t.accept, t.discard, t.activities("all"))


@register("coupon_unit_cost", _D + """
SELECT id, web_id, coupon_type, CAST(unit_cost AS BIGINT) AS unit_cost FROM camp""")
def q_coupon_unit_cost(spark, sf_dir):
    return CAMP.unit_cost(_part_activities(spark, sf_dir), A.supplier_stat(spark, sf_dir)).select("id", "web_id", "coupon_type", "unit_cost")


@register("campaigns_running", _D + f"""
SELECT a.id, a.web_id, a.link_code, a.coupon_type, a.coupon_amount, a.activity_start, a.activity_end,
       a.coupon_total, a.coupon_price_limit
FROM act a JOIN campaigns c ON c.id = a.id
WHERE {_ASOF} BETWEEN c.start_time AND c.end_time AND c.activity_enable = 1 AND c.coupon_enable = 1
  AND c.activity_delete = 0""")
def q_campaigns_running(spark, sf_dir):
    return _part_activities(spark, sf_dir, "running").select(*CAMP.CAMPAIGN_COLUMNS)


@register("campaigns_just_expired", _D + f"""
SELECT a.id, a.web_id, a.link_code, a.coupon_type, a.coupon_amount, a.activity_start, a.activity_end,
       a.coupon_total, a.coupon_price_limit
FROM act a JOIN campaigns c ON c.id = a.id
WHERE CAST(c.update_time AS DATE) BETWEEN c.start_time AND c.end_time
  AND date_diff('day', c.end_time, {_ASOF}) BETWEEN 0 AND 1
  AND c.activity_enable = 1 AND c.coupon_enable = 1 AND c.activity_delete = 0""")
def q_campaigns_just_expired(spark, sf_dir):
    return _part_activities(spark, sf_dir, "just_expired").select(*CAMP.CAMPAIGN_COLUMNS)


@register("campaigns_by_id", _D + """
SELECT id, web_id, link_code, coupon_type, coupon_amount, activity_start, activity_end, coupon_total, coupon_price_limit
FROM act WHERE id IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)""")
def q_campaigns_by_id(spark, sf_dir):
    """F09/F10 by_id: campaigns of the parts that are ordered in large numbers."""
    ids = A.read_table(spark, sf_dir, "lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("id"))
    return _part_activities(spark, sf_dir, "by_id", ids=ids).select(*CAMP.CAMPAIGN_COLUMNS)


@register("coupon_budget", _D + f"""
SELECT id, web_id, CAST(coupon_total - coupon_used AS DOUBLE) / (1 + date_diff('day', {_ASOF}, end_time)) AS avg_n_coupon
FROM campaigns
WHERE date_diff('day', {_ASOF}, start_time) <= 2 AND {_ASOF} <= end_time AND activity_enable = 1
  AND coupon_enable = 1 AND activity_delete = 0""")
def q_coupon_budget(spark, sf_dir):
    return CAMP.upcoming_budget(A.part_campaigns(spark, sf_dir), A.AS_OF)


@register("stale_coupons", _D + f"""
SELECT id, web_id, CAST(MAX(g.n) AS INTEGER) AS unused_days
FROM campaigns c, range(1, 11) g(n)
WHERE ad_image_url = '_' AND activity_delete = 0 AND coupon_enable = 1 AND activity_enable = 1
  AND start_time < {_ASOF} - CAST(g.n AS INTEGER) AND end_time > {_ASOF} AND coupon_used = 0
GROUP BY id, web_id""")
def q_stale_coupons(spark, sf_dir):
    return CAMP.stale_coupons(A.part_campaigns(spark, sf_dir), A.AS_OF)


@register("campaign_assembly", O.prefix(A.MIXED_CELLS, [O.ACTIVITY, O.CAMP]) + """,
roas AS (""" + "\nUNION ALL\n".join(
    O.lifetime_cell(tt, cc, [w for w, c in A.MIXED_CELLS.items() if c == (tt, cc)])
    for (tt, cc) in sorted(set(A.MIXED_CELLS.values()))) + f"""),
reach AS (SELECT c.id AS coupon_id,
  (SELECT COUNT(DISTINCT s.uuid) FROM send s WHERE s.coupon_id = c.id
        AND s.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) AS coupon_sent,
  (SELECT COUNT(DISTINCT a.uuid) FROM accept a WHERE a.coupon_id = c.id
        AND a.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) AS coupon_accept,
  (SELECT COUNT(*) FROM (SELECT a.uuid FROM accept a WHERE a.coupon_id = c.id
        AND a.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)
        UNION SELECT d.uuid FROM discard d WHERE d.coupon_id = c.id
        AND d.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) x) AS coupon_impression
  FROM act c)
SELECT r.coupon_id, r.web_id, r.revenue, r.cost, CAST(x.coupon_sent AS BIGINT) AS coupon_sent,
  CAST(x.coupon_impression AS BIGINT) AS coupon_impression, CAST(x.coupon_accept AS BIGINT) AS coupon_accept,
  r.coupon_used,
  CASE WHEN date_diff('day', {_ASOF}, c.activity_end) = 0 THEN 0.0
       ELSE CAST(c.coupon_total - r.coupon_used AS DOUBLE) / date_diff('day', {_ASOF}, c.activity_end) END AS avg_n_coupon
FROM roas r JOIN reach x ON x.coupon_id = r.coupon_id JOIN act c ON c.id = r.coupon_id""")
def q_campaign_assembly(spark, sf_dir):
    t = Tables(spark, sf_dir, A.MIXED_CELLS)
    return ATT.campaign_assembly(t.send, t.accept, t.discard, t.purchase, t.enter, t.activities("all"),
                                 t.cells, t.addfan_stat, A.AS_OF)


# ------------------------------------------------------ banners, orders
_GRAIN = {"date": "CAST(date_time AS DATE)", "hour": "CAST(hour(date_time) AS INTEGER)"}


def _banner_sql(grain, click_before: bool = False) -> str:
    g = ", ".join(grain)
    made = ", ".join(f"{_GRAIN[x]} AS {x}" for x in grain)
    same = lambda a, b, cols: " AND ".join(f"{a}.{c} = {b}.{c}" for c in cols)
    session = [*grain, "web_id", "uuid", "session_id"]
    rows = f"""sess AS (SELECT {g}, web_id, uuid, session_id, SUM(revenue) AS revenue FROM orev GROUP BY ALL),
cr AS (SELECT {", ".join("s." + x for x in grain)}, s.web_id, k.rt AS recommend_type, SUM(s.revenue) AS revenue, COUNT(*) AS n
       FROM sess s JOIN credit k ON {same("s", "k", session)} GROUP BY ALL)"""
    if click_before:
        rows = f"""per AS (SELECT {", ".join("o." + x for x in session)}, o."timestamp", o.revenue,
       (SELECT MIN(k.recommend_type) FROM c k WHERE {same("o", "k", session)} AND k."timestamp" <= o."timestamp") AS rt
       FROM orev o),
cr AS (SELECT {g}, web_id, rt AS recommend_type, SUM(revenue) AS revenue, COUNT(DISTINCT (uuid, session_id)) AS n
       FROM per WHERE rt IS NOT NULL GROUP BY {g}, web_id, rt)"""
    return O.prefix() + f""",
c AS (SELECT {made}, web_id, uuid, session_id, "timestamp", recommend_type FROM clicks WHERE recommend_type BETWEEN 0 AND 10),
stats AS (SELECT {g}, web_id, recommend_type, COUNT(*) AS clicks, COUNT(DISTINCT (uuid, session_id)) AS sessions
          FROM c GROUP BY ALL),
credit AS (SELECT {g}, web_id, uuid, session_id, MIN(recommend_type) AS rt FROM c GROUP BY ALL),
pd AS (SELECT {made}, * FROM purchase),
orev AS """ + O.order_rev_sql("pd", [*session, '"timestamp"']) + f""",
{rows}
SELECT {", ".join("st." + x for x in grain)}, st.web_id, CAST(st.recommend_type AS INTEGER) AS recommend_type,
  CAST(COALESCE(cr.revenue, 0) AS DOUBLE) AS revenue, CAST(st.clicks AS BIGINT) AS clicks,
  CAST(st.sessions AS BIGINT) AS sessions, CAST(COALESCE(cr.n, 0) AS BIGINT) AS "transaction"
FROM stats st LEFT JOIN cr ON {same("cr", "st", [*grain, "web_id", "recommend_type"])}"""


def _banners(grain, **options):
    def q(spark, sf_dir):
        t = Tables(spark, sf_dir)
        cols = {"date": F.to_date("date_time"), "hour": F.hour("date_time")}
        made = {x: cols[x] for x in grain}
        return BAN.banner_revenue(t.purchase.withColumns(made), t.clicks.withColumns(made), grain, **options)
    q.__doc__ = f"A12 by {' and '.join(grain)}."
    return q


register("banner_revenue", _banner_sql(["date"]))(_banners(["date"]))
register("banner_revenue_hourly", _banner_sql(["date", "hour"]))(_banners(["date", "hour"]))
register("banner_revenue_click_before", _banner_sql(["date"], True))(_banners(["date"], require_click_before=True))


@register("site_daily_totals", O.prefix() + """,
us AS (SELECT web_id, CAST(date_time AS DATE) AS date, COUNT(DISTINCT uuid) AS users,
       COUNT(DISTINCT (uuid, session_id)) AS sessions FROM load GROUP BY web_id, CAST(date_time AS DATE)),
pd AS (SELECT u.date, p.* FROM us u JOIN purchase p ON p.web_id = u.web_id
       AND p.date_time BETWEEN CAST(u.date AS TIMESTAMP) AND CAST(u.date + 1 AS TIMESTAMP)),
orev AS """ + O.order_rev_sql("pd", ["date", "web_id", "uuid", "session_id", '"timestamp"']) + """,
tot AS (SELECT date, web_id, SUM(revenue) AS total_revenue, COUNT(*) AS transactions FROM orev GROUP BY date, web_id)
SELECT us.web_id, CAST(COALESCE(tot.total_revenue, 0) AS DOUBLE) AS total_revenue, CAST(us.users AS BIGINT) AS users,
  CAST(us.sessions AS BIGINT) AS sessions, CAST(COALESCE(tot.transactions, 0) AS BIGINT) AS transactions, us.date
FROM us LEFT JOIN tot ON tot.date = us.date AND tot.web_id = us.web_id""")
def q_site_daily_totals(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return BAN.site_daily_totals(t.purchase, t.load)


def lineitem_lines(spark, sf_dir):
    """Second, larger order source: lineitem rows as purchase lines of the
    order ``l_orderkey`` (line order = l_linenumber)."""
    li = A.read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("w"), (F.col("l_orderkey") % 5).cast("string")).alias("web_id"),
        F.lpad(F.col("l_orderkey").cast("string"), 36, "0").alias("uuid"),
        F.lit("0").alias("session_id"), F.col("l_orderkey").alias("timestamp"),
        F.col("l_linenumber").cast("bigint").alias("ord"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice").cast("decimal(18,2)")
               * (1 - F.col("l_discount").cast("decimal(18,2)")))
         .otherwise(F.lit(-1).cast("decimal(18,2)")).alias("total_price"),
        F.when(F.col("l_linestatus") == "O", F.lit(-1).cast("decimal(18,2)"))
         .otherwise(F.col("l_extendedprice").cast("decimal(18,2)")).alias("product_price"),
        F.col("l_quantity").cast("int").alias("product_quantity"))


_LINES_SQL = """lines AS (SELECT 'w' || CAST(l_orderkey % 5 AS VARCHAR) AS web_id,
    lpad(CAST(l_orderkey AS VARCHAR), 36, '0') AS uuid, '0' AS session_id, l_orderkey AS "timestamp",
    CAST(l_linenumber AS BIGINT) AS ord,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
         ELSE CAST(-1 AS DECIMAL(18,2)) END AS total_price,
    CASE WHEN l_linestatus = 'O' THEN CAST(-1 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS product_price,
    CAST(l_quantity AS INTEGER) AS product_quantity FROM lineitem)"""


@register("order_revenue", "WITH " + _LINES_SQL + ", r AS " + O.order_rev_sql(
    "lines", ["web_id", "uuid", "session_id", '"timestamp"']) + """
SELECT web_id, uuid, session_id, "timestamp", CAST(revenue AS DOUBLE) AS revenue FROM r""")
def q_order_revenue(spark, sf_dir):
    """A13 on lineitem: order value with the last-positive-total rule."""
    r = ORD.order_revenue(lineitem_lines(spark, sf_dir))
    return r.withColumn("revenue", F.col("revenue").cast("double"))


@register("session_revenue", "WITH " + _LINES_SQL + ", r AS " + O.order_rev_sql(
    "lines", ["web_id", "uuid", "session_id", '"timestamp"']) + """
SELECT web_id, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(COUNT(*) AS BIGINT) AS orders FROM r GROUP BY web_id""")
def q_session_revenue(spark, sf_dir):
    """A14 rolled to tenants: sum of order revenue."""
    r = ORD.order_revenue(lineitem_lines(spark, sf_dir))
    return r.groupBy("web_id").agg(F.sum("revenue").cast("double").alias("revenue"),
                                   F.count(F.lit(1)).cast("bigint").alias("orders"))


@register("revenue_per_session", O.prefix() + ", r AS " + O.order_rev_sql(
    "purchase", ["web_id", "uuid", "session_id", '"timestamp"']) + """
SELECT web_id, uuid, session_id, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM r GROUP BY ALL""")
def q_revenue_per_session(spark, sf_dir):
    """Order revenue by session."""
    r = ORD.session_revenue(ORD.order_revenue(Tables(spark, sf_dir).purchase))
    return r.withColumn("revenue", F.col("revenue").cast("double"))


@register("avg_order_value", O.prefix() + """
SELECT t.web_id, CAST(trunc(COALESCE(s.sh, -1)) AS BIGINT) AS avg_shipping_price,
       CAST(trunc(COALESCE(o.aov, -1)) AS BIGINT) AS avg_total_price
FROM (SELECT DISTINCT web_id FROM purchase) t
LEFT JOIN (SELECT web_id, AVG(shipping_price) AS sh FROM purchase WHERE shipping_price != 0 GROUP BY web_id) s ON s.web_id = t.web_id
LEFT JOIN (SELECT web_id, CAST(SUM(total) AS DOUBLE) / COUNT(total) AS aov FROM (
    SELECT web_id, SUM(product_price * product_quantity) AS total FROM purchase
    GROUP BY web_id, uuid, session_id, "timestamp") GROUP BY web_id) o ON o.web_id = t.web_id""")
def q_avg_order_value(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ORD.price_averages(t.purchase)


@register("order_totals", O.prefix() + """
SELECT web_id, uuid, session_id, "timestamp", CAST(SUM(product_price * product_quantity) AS DOUBLE) AS total,
  ROUND(AVG(ABS(""" + O.num("coupon") + """)), 6) AS coupon_avg
FROM purchase GROUP BY web_id, uuid, session_id, "timestamp"
HAVING SUM(product_price * product_quantity) > 20""")
def q_order_totals(spark, sf_dir):
    """A03 with a minimum spend of 20."""
    t = Tables(spark, sf_dir)
    o = ORD.order_totals(t.purchase, min_total=20)
    return o.select("web_id", "uuid", "session_id", "timestamp", F.col("total").cast("double").alias("total"),
                    F.round("coupon_avg", 6).alias("coupon_avg"))


@register("first_order_per_session", O.prefix() + """
SELECT web_id, uuid, session_id, arg_min("timestamp", ("timestamp", ord)) AS "timestamp",
  CAST(arg_min(total, ("timestamp", ord)) AS DOUBLE) AS total
FROM (SELECT web_id, uuid, session_id, "timestamp", MIN(ord) AS ord,
        SUM(product_price * product_quantity) AS total FROM purchase
      GROUP BY web_id, uuid, session_id, "timestamp") GROUP BY web_id, uuid, session_id""")
def q_first_order_per_session(spark, sf_dir):
    """One order per session (earliest)."""
    t = Tables(spark, sf_dir)
    o = ORD.order_totals(t.purchase).drop("coupon_avg")
    f = ORD.first_order_per_session(o)
    return f.select("web_id", "uuid", "session_id", "timestamp", F.col("total").cast("double").alias("total"))


# ------------------------------------------------------------ statistics
def _stat_cols(types, sessions: bool, pb: bool) -> str:
    out = []
    for t in types:
        out.append(f"CAST(COUNT(*) FILTER (WHERE etype = '{t}') AS BIGINT) AS n_events_{t}")
        out.append(f"CAST(COUNT(DISTINCT uuid) FILTER (WHERE etype = '{t}') AS BIGINT) AS n_uuid_{t}")
        if sessions:
            out.append(f"CAST(COUNT(DISTINCT (uuid, session_id)) FILTER (WHERE etype = '{t}') AS BIGINT) AS n_sessions_{t}")
    if pb:
        out.append("CAST(COUNT(DISTINCT uuid) FILTER (WHERE etype = 'load' AND is_purchased_before = 1) AS BIGINT) AS n_uuid_load_purchased_before")
        out.append("CAST(COUNT(DISTINCT uuid) FILTER (WHERE etype = 'purchase' AND is_purchased_before = 1) AS BIGINT) AS n_uuid_purchase_purchased_before")
    return ",\n  ".join(out)


_TRACKER_U = " UNION ALL ".join(
    f"SELECT '{t}' AS etype, web_id, uuid, session_id, date_time, is_purchased_before FROM t_{t}"
    for t in ST.TRACKER_TYPES)
_COUPON_U = (" SELECT 'sendCoupon' AS etype, web_id, uuid, date_time FROM send UNION ALL "
             "SELECT 'acceptCoupon', web_id, uuid, date_time FROM accept UNION ALL "
             "SELECT 'discardCoupon', web_id, uuid, date_time FROM discard")
_TRACKER_SQL = (f"SELECT web_id, CAST(date_time AS DATE) AS date,\n  {_stat_cols(ST.TRACKER_TYPES, True, True)}\n"
                f"FROM ({_TRACKER_U}) u GROUP BY web_id, CAST(date_time AS DATE) "
                "HAVING COUNT(*) FILTER (WHERE etype = 'load') > 0")
_COUPON_SQL = (f"SELECT web_id, CAST(date_time AS DATE) AS date,\n  {_stat_cols(ST.COUPON_TYPES, False, False)}\n"
               f"FROM ({_COUPON_U}) u GROUP BY web_id, CAST(date_time AS DATE)")


def _stat_tables(t: Tables) -> dict:
    tabs = A.tracker_tables(t.ev)
    tabs.update({"sendCoupon": t.send, "acceptCoupon": t.accept, "discardCoupon": t.discard})
    return tabs


@register("tracker_stats", O.prefix() + "\n" + _TRACKER_SQL)
def q_tracker_stats(spark, sf_dir):
    return ST.tracker_statistics(_stat_tables(Tables(spark, sf_dir)))


@register("coupon_stats", O.prefix() + "\n" + _COUPON_SQL)
def q_coupon_stats(spark, sf_dir):
    return ST.coupon_statistics(_stat_tables(Tables(spark, sf_dir)))


@register("event_stats", O.prefix() + f", tr AS ({_TRACKER_SQL}), co AS ({_COUPON_SQL})\n"
          "SELECT * FROM tr FULL OUTER JOIN co USING (web_id, date)")
def q_event_stats(spark, sf_dir):
    return ST.event_statistics(_stat_tables(Tables(spark, sf_dir)))


# ------------------------------------------------------ ads, batch codes
@register("ad_growth", _P + f""",
ads AS (SELECT a.* FROM act a JOIN campaigns c ON c.id = a.id
        WHERE {_ASOF} BETWEEN c.start_time AND c.end_time AND c.activity_enable = 1 AND c.ad_enable = 1
          AND c.activity_delete = 0)
SELECT c.id,
  CAST((SELECT COUNT(DISTINCT uuid) FROM accept_af x WHERE x.web_id = c.web_id AND x.ad_id = c.id
        AND x.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP))
     + CASE WHEN c.ad_url = c.ad_btn_url THEN
        (SELECT COUNT(DISTINCT uuid) FROM accept_ad x WHERE x.web_id = c.web_id AND x.ad_id = c.id
        AND x.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) ELSE 0 END
     AS BIGINT) AS addfan_growth,
  CAST((SELECT COUNT(*) FROM send_afad x WHERE x.web_id = c.web_id AND x.ad_id = c.id
        AND x.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP) AND CAST(c.activity_end AS TIMESTAMP)) AS BIGINT)
     AS addfan_impression
FROM ads c""")
def q_ad_growth(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ads = t.activities("running", flag="ad_enable")
    return ADS.ad_growth(t.accept_af, t.accept_ad, t.send_afad, ads)


@register("coupon_release", _P + f""",
sent AS (SELECT web_id, 'L' || CAST({O.CID} AS VARCHAR) AS link_code,
           CAST(user_id AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS coupon_code, 1 AS is_sent, ts AS update_time
         FROM ev WHERE event_type = 'view'),
acc AS (SELECT web_id, 'L' || CAST({O.CID} AS VARCHAR) AS link_code,
           CAST(user_id AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS coupon_code FROM ev WHERE event_type = 'signup'),
batch AS (SELECT DISTINCT web_id, link_code FROM campaigns
          WHERE coupon_code_mode IN (1, 2) AND {_ASOF} BETWEEN start_time AND end_time
            AND activity_enable = 1 AND coupon_enable = 1 AND activity_delete = 0)
SELECT DISTINCT s.web_id, s.link_code, s.coupon_code, 0 AS is_sent
FROM sent s JOIN batch b ON b.web_id = s.web_id AND b.link_code = s.link_code
WHERE s.is_sent = 1 AND s.update_time < TIMESTAMP '{A.AS_OF.isoformat(sep=" ")}' - INTERVAL 2 HOUR
  AND NOT EXISTS (SELECT 1 FROM acc a WHERE a.web_id = s.web_id AND a.link_code = s.link_code
                  AND a.coupon_code = s.coupon_code)""")
def q_coupon_release(spark, sf_dir):
    t = Tables(spark, sf_dir)
    sent, acc = A.batch_codes(t.ev)
    batch = t.activities("running", code_modes=(1, 2))
    return CPN.coupon_release(sent, acc, batch, A.AS_OF)


# ------------------------------------------------- features and the model
from sparktrail.operators import describe as DES  # noqa: E402
from sparktrail.operators import features as FEA  # noqa: E402
from sparktrail.operators import model as MOD  # noqa: E402
from sparktrail.operators import ordered as ORDR  # noqa: E402

FEATURE_KEYS = ["web_id", "timestamp", "device", "pageviews", "click_count_total", "landing_count",
                "time_pageview_total", "is_purchased_before"]
MODEL_FEATURES = ["device", "pageviews", "click_count_total", "landing_count", "time_pageview_total"]


def _session_features(t: Tables, match="any_exact", within=lambda df: df):
    tabs = A.tracker_tables(t.ev)
    roles = (within(df) for df in (t.load, t.purchase, tabs["addCart"], tabs["removeCart"]))
    return FEA.session_features(*roles, FEATURE_KEYS, match)


def _scored(t: Tables):
    vm = FEA.visitor_max(_session_features(t))
    return MOD.score(vm, MOD.model_params(t.settings), MODEL_FEATURES)


def _last(c):
    return f'arg_max({c}, ("timestamp", ord)) FILTER (WHERE {c} IS NOT NULL) AS {c}'


_FLAGS = """fl AS (SELECT l.*,
   CASE WHEN EXISTS (SELECT 1 FROM purchase p WHERE p.uuid = l.uuid AND p.session_id = l.session_id) THEN 1 ELSE 0 END AS is_purchased,
   CASE WHEN EXISTS (SELECT 1 FROM t_addCart p WHERE p.uuid = l.uuid AND p.session_id = l.session_id) THEN 1 ELSE 0 END AS is_addCart,
   CASE WHEN EXISTS (SELECT 1 FROM t_removeCart p WHERE p.uuid = l.uuid AND p.session_id = l.session_id) THEN 1 ELSE 0 END AS is_removeCart
  FROM load l WHERE length(uuid) = 36)"""
_SF_COLS = [c for c in FEATURE_KEYS] + ["is_purchased", "is_addCart", "is_removeCart"]
_SF = "sf AS (SELECT uuid, session_id, " + ", ".join(_last(c) for c in _SF_COLS) + " FROM fl GROUP BY uuid, session_id)"
_VM = ("vm AS (SELECT * FROM (SELECT uuid, max(session_id) AS session_id, "
       + ", ".join(f"max({c}) AS {c}" for c in _SF_COLS) + " FROM sf GROUP BY uuid) WHERE device != 0 AND is_purchased_before = 0)")
_LIN = ("((((0.0 + CAST(device AS DOUBLE) * 0.2) + CAST(pageviews AS DOUBLE) * 0.15) + CAST(click_count_total AS DOUBLE) * 0.01)"
        " + CAST(landing_count AS DOUBLE) * -0.3) + CAST(time_pageview_total AS DOUBLE) * 0.002")
_SC = f"sc AS (SELECT vm.*, 1.0 / (1.0 + exp(-({_LIN} + s.model_intercept))) AS prob FROM vm JOIN settings s ON s.web_id = vm.web_id)"
_FEAT_P = O.prefix(None, [_FLAGS, _SF, _VM, _SC])


@register("session_features", _FEAT_P + "\nSELECT * FROM sf")
def q_session_features(spark, sf_dir):
    """Last non-null feature values per session with action flags."""
    return _session_features(Tables(spark, sf_dir))


@register("session_features_last_contains", O.prefix(None, [
    _FLAGS.replace("EXISTS (SELECT 1 FROM purchase p WHERE p.uuid = l.uuid AND p.session_id = l.session_id)",
                   "contains((SELECT arg_max(p.session_id, (p.\"timestamp\", p.ord)) FROM purchase p WHERE p.uuid = l.uuid), l.session_id)")
         .replace("EXISTS (SELECT 1 FROM t_addCart p WHERE p.uuid = l.uuid AND p.session_id = l.session_id)",
                  "contains((SELECT arg_max(p.session_id, (p.\"timestamp\", p.ord)) FROM t_addCart p WHERE p.uuid = l.uuid), l.session_id)")
         .replace("EXISTS (SELECT 1 FROM t_removeCart p WHERE p.uuid = l.uuid AND p.session_id = l.session_id)",
                  "contains((SELECT arg_max(p.session_id, (p.\"timestamp\", p.ord)) FROM t_removeCart p WHERE p.uuid = l.uuid), l.session_id)")
         .replace("THEN 1 ELSE 0 END", "IS TRUE THEN 1 ELSE 0 END"), _SF]) + "\nSELECT * FROM sf")
def q_session_features_last_contains(spark, sf_dir):
    """A19 with the reference's literal flag rule (Q1)."""
    return _session_features(Tables(spark, sf_dir), match="last_contains")


_VF_COLS = [c for c in FEATURE_KEYS if c != "web_id"] + ["web_id", "is_purchased", "is_addCart", "is_removeCart"]


@register("visitor_features", O.prefix() + """,
fl AS (SELECT l.*,
   CASE WHEN EXISTS (SELECT 1 FROM purchase p WHERE p.uuid = l.uuid) THEN 1 ELSE 0 END AS is_purchased,
   CASE WHEN EXISTS (SELECT 1 FROM t_addCart p WHERE p.uuid = l.uuid) THEN 1 ELSE 0 END AS is_addCart,
   CASE WHEN EXISTS (SELECT 1 FROM t_removeCart p WHERE p.uuid = l.uuid) THEN 1 ELSE 0 END AS is_removeCart
  FROM load l WHERE length(uuid) = 36 AND landing_count > 0)
SELECT uuid, """ + ", ".join(_last(c) for c in ["session_id"] + _VF_COLS) + " FROM fl GROUP BY uuid")
def q_visitor_features(spark, sf_dir):
    """Last non-null values per visitor with landing_count > 0."""
    t = Tables(spark, sf_dir)
    tabs = A.tracker_tables(t.ev)
    return FEA.visitor_features(t.load, t.purchase, tabs["addCart"], tabs["removeCart"],
                                ["session_id", *FEATURE_KEYS])


@register("visitor_max", _FEAT_P + "\nSELECT * FROM vm")
def q_visitor_max(spark, sf_dir):
    """Per-visitor max of the session features, mobile new buyers."""
    return FEA.visitor_max(_session_features(Tables(spark, sf_dir)))


@register("score_visitors", _FEAT_P + "\nSELECT * FROM sc")
def q_score_visitors(spark, sf_dir):
    """Each tenant's stored logistic model applied in one pass."""
    return _scored(Tables(spark, sf_dir))


@register("confusion_matrix", _FEAT_P + """
SELECT web_id, is_purchased, CASE WHEN prob BETWEEN 0.5 AND 1.0 THEN 1 ELSE 0 END AS predict,
  CAST(COUNT(*) AS BIGINT) AS n FROM sc GROUP BY ALL""")
def q_confusion_matrix(spark, sf_dir):
    """M05 + M06 at the default 0.5 band."""
    return MOD.confusion(MOD.label_band(_scored(Tables(spark, sf_dir)), 0.5))


@register("precision", _FEAT_P + """
SELECT web_id, CAST(SUM(CASE WHEN is_purchased = 1 AND prob BETWEEN 0.3 AND 1.0 THEN 1 ELSE 0 END) AS DOUBLE)
   / NULLIF(SUM(CASE WHEN prob BETWEEN 0.3 AND 1.0 THEN 1 ELSE 0 END), 0) AS precision
FROM sc GROUP BY web_id""")
def q_precision(spark, sf_dir):
    """TP / PP at a 0.3 band (null when nothing is predicted)."""
    return MOD.precision(MOD.label_band(_scored(Tables(spark, sf_dir)), 0.3))


@register("roc_points", _FEAT_P + """,
d AS (SELECT web_id, prob AS threshold, SUM(CAST(is_purchased AS DOUBLE)) AS pos,
        SUM(1 - CAST(is_purchased AS DOUBLE)) AS neg FROM sc GROUP BY web_id, prob)
SELECT web_id, threshold,
  SUM(neg) OVER (PARTITION BY web_id ORDER BY threshold DESC) / NULLIF(SUM(neg) OVER (PARTITION BY web_id), 0) AS fpr,
  SUM(pos) OVER (PARTITION BY web_id ORDER BY threshold DESC) / NULLIF(SUM(pos) OVER (PARTITION BY web_id), 0) AS tpr
FROM d""")
def q_roc_points(spark, sf_dir):
    """ROC points per tenant."""
    return MOD.roc_points(_scored(Tables(spark, sf_dir)))


@register("feature_corr", _FEAT_P + "\nSELECT web_id, " + ", ".join(
    f"corr(CAST({c} AS DOUBLE), CAST(is_purchased AS DOUBLE)) AS {c}" for c in ["pageviews", "click_count_total", "time_pageview_total"])
    + " FROM sf GROUP BY web_id")
def q_feature_corr(spark, sf_dir):
    """Correlation of session features with the purchase flag."""
    return MOD.feature_corr(_session_features(Tables(spark, sf_dir)),
                            ["pageviews", "click_count_total", "time_pageview_total"])


_ZC = ["pageviews", "click_count_total", "time_pageview_total"]


@register("zscore", _FEAT_P + ", st AS (SELECT web_id, " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in _ZC)
    + " FROM sf GROUP BY web_id)\nSELECT sf.uuid, sf.session_id, sf.web_id, " + ", ".join(
    f"COALESCE(CASE WHEN s_{c} = 0 THEN NULL ELSE (CAST(sf.{c} AS DOUBLE) - m_{c}) / s_{c} END, 0.0) AS {c}" for c in _ZC)
    + " FROM sf JOIN st ON st.web_id = sf.web_id")
def q_zscore(spark, sf_dir):
    """Per-tenant z-scores of session features."""
    sf = _session_features(Tables(spark, sf_dir)).select("uuid", "session_id", "web_id", *_ZC)
    return DES.zscore(sf, _ZC, group=["web_id"])


def _hist_sql(src: str, value: str, n: int, group: str) -> str:
    return f"""st AS (SELECT {group}, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                 CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi, COUNT(*) AS tot
               FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v FROM {src}) GROUP BY {group}),
st2 AS (SELECT *, (hi - lo) / {float(n)} AS step FROM st),
b0 AS (SELECT x.{group}, x.v, st2.lo, st2.hi, st2.step,
         LEAST(CAST(trunc((x.v - st2.lo) * ({float(n)} / (st2.hi - st2.lo))) AS BIGINT), {n - 1}) AS f
       FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v FROM {src}) x JOIN st2 ON st2.{group} = x.{group}),
b1 AS (SELECT {group}, CASE WHEN v < CAST(f AS DOUBLE) * step + lo THEN f - 1
         WHEN f != {n - 1} AND v >= (CASE WHEN f + 1 >= {n} THEN hi ELSE CAST(f + 1 AS DOUBLE) * step + lo END) THEN f + 1
         ELSE f END AS bin FROM b0),
cnt AS (SELECT {group}, bin, COUNT(*) AS c FROM b1 GROUP BY ALL),
spine AS (SELECT st2.*, g.bin FROM st2, range(0, {n}) g(bin)),
hist AS (SELECT s.{group}, s.bin, CASE WHEN s.bin >= {n} THEN s.hi ELSE CAST(s.bin AS DOUBLE) * s.step + s.lo END AS "left",
       CASE WHEN s.bin + 1 >= {n} THEN s.hi ELSE CAST(s.bin + 1 AS DOUBLE) * s.step + s.lo END AS "right",
       CAST(COALESCE(c.c, 0) AS BIGINT) AS count, CAST(COALESCE(c.c, 0) AS DOUBLE) / s.tot / s.step AS density
     FROM spine s LEFT JOIN cnt c ON c.{group} = s.{group} AND c.bin = s.bin)"""


@register("histogram", _FEAT_P + ", " + _hist_sql("sc", "prob", 10, "web_id") + "\nSELECT * FROM hist")
def q_histogram(spark, sf_dir):
    """10 equal bins of model scores per tenant, with density."""
    return DES.histogram(_scored(Tables(spark, sf_dir)), "prob", 10, group=["web_id"], density=True)


@register("cumulative_histogram", _FEAT_P + ", " + _hist_sql("sc", "prob", 10, "web_id")
          + "\nSELECT web_id, bin, count, CAST(SUM(count) OVER (PARTITION BY web_id) - SUM(count) OVER "
            "(PARTITION BY web_id ORDER BY bin) AS BIGINT) AS cum FROM hist")
def q_cumulative_histogram(spark, sf_dir):
    """Reverse cumulative counts over score bins."""
    h = DES.histogram(_scored(Tables(spark, sf_dir)), "prob", 10, group=["web_id"])
    return DES.cumulative_counts(h, ["web_id"], reverse=True).select("web_id", "bin", "count", "cum")


@register("class_histogram", _FEAT_P + """,
x AS (SELECT is_purchased, CAST(pageviews AS DOUBLE) AS v FROM sf WHERE pageviews IS NOT NULL AND pageviews >= 0 AND pageviews <= 20),
cnt AS (SELECT is_purchased, LEAST(CAST(floor(v / 1.0) AS BIGINT), 19) AS bin, COUNT(*) AS c FROM x GROUP BY ALL),
tot AS (SELECT is_purchased, COUNT(*) AS t FROM x GROUP BY ALL)
SELECT tot.is_purchased, g.bin, 0.0 + g.bin * 1.0 + 0.5 AS center, CAST(COALESCE(c, 0) AS BIGINT) AS count,
  CAST(COALESCE(c, 0) AS DOUBLE) / t / 1.0 AS density
FROM tot, range(0, 20) g(bin) LEFT JOIN cnt ON cnt.is_purchased = tot.is_purchased AND cnt.bin = g.bin""")
def q_class_histogram(spark, sf_dir):
    """Pageviews density for purchasers vs others (width 1, 0..20)."""
    return DES.class_histogram(_session_features(Tables(spark, sf_dir)), "pageviews", 1.0, 0.0, 20.0)


@register("bound_by_rank", _FEAT_P + f""",
bud AS (SELECT id, web_id, CAST(coupon_total - coupon_used AS DOUBLE) / (1 + date_diff('day', {_ASOF}, end_time)) AS avg_n_coupon
  FROM campaigns WHERE date_diff('day', {_ASOF}, start_time) <= 2 AND {_ASOF} <= end_time AND activity_enable = 1
  AND coupon_enable = 1 AND activity_delete = 0),
rk AS (SELECT web_id, uuid, prob, ROW_NUMBER() OVER (PARTITION BY web_id ORDER BY prob DESC, uuid) AS rnk,
       COUNT(*) OVER (PARTITION BY web_id) AS n FROM sc),
tr AS (SELECT web_id, SUM(CASE WHEN pageviews > 1 THEN 1 ELSE 0 END) AS pv FROM sc GROUP BY web_id),
b AS (SELECT bud.*, CAST(s.n_day_testing AS DOUBLE) AS n_day, s.n_weight, s.model_intercept AS b0,
        CAST(floor(tr.pv / CAST(s.n_day_testing AS DOUBLE)) AS BIGINT) AS max_n_coupon
      FROM bud JOIN settings s ON s.web_id = bud.web_id JOIN tr ON tr.web_id = bud.web_id),
b2 AS (SELECT b.*, (CASE WHEN avg_n_coupon * n_weight >= max_n_coupon THEN CAST(floor(max_n_coupon * n_day) AS BIGINT)
         ELSE CAST(trunc(avg_n_coupon * n_day * n_weight) AS BIGINT) END) - 1 AS pos FROM b),
b3 AS (SELECT b2.*, (CASE WHEN pos < 0 THEN pos + (SELECT max(n) FROM rk WHERE rk.web_id = b2.web_id) ELSE pos END) + 1 AS rr FROM b2),
lb AS (SELECT b3.*, CASE WHEN rk.prob <= 1.0 / (1.0 + exp(-b0)) THEN 1.0 / (1.0 + exp(-b0)) * 1.1 ELSE rk.prob END AS lower_bound
       FROM b3 LEFT JOIN rk ON rk.web_id = b3.web_id AND rk.rnk = b3.rr),
pr AS (SELECT lb.id, COUNT(sc.uuid) AS pp, SUM(CASE WHEN sc.is_purchased = 1 THEN 1 ELSE 0 END) AS tp,
         COUNT(DISTINCT sc.uuid) AS pu
       FROM lb LEFT JOIN sc ON sc.web_id = lb.web_id AND sc.prob BETWEEN lb.lower_bound AND 1.0 GROUP BY lb.id)
SELECT lb.id, lb.max_n_coupon, lb.avg_n_coupon, lb.lower_bound,
  CAST(floor(COALESCE(pr.pu, 0) / lb.n_day) AS BIGINT) AS estimated_n_coupon,
  CAST(COALESCE(pr.tp, 0) AS DOUBLE) / (CAST(COALESCE(pr.pp, 0) AS DOUBLE) + 0.1) AS model_precision
FROM lb LEFT JOIN pr ON pr.id = lb.id""")
def q_bound_by_rank(spark, sf_dir):
    """M13 + M17: score floor per running campaign, precision and estimate."""
    t = Tables(spark, sf_dir)
    budgets = CAMP.upcoming_budget(t.campaigns_raw, A.AS_OF)
    return MOD.bound_assembly(_scored(t), budgets, MOD.model_params(t.settings))


@register("estimate_coupons", _FEAT_P + """
SELECT sc.web_id, CAST(floor(COUNT(DISTINCT uuid) / CAST(s.n_day_testing AS DOUBLE)) AS BIGINT) AS estimated_n_coupon
FROM sc JOIN settings s ON s.web_id = sc.web_id WHERE prob BETWEEN 0.3 AND 1.0 GROUP BY sc.web_id, s.n_day_testing""")
def q_estimate_coupons(spark, sf_dir):
    """M16 at a 0.3 band."""
    t = Tables(spark, sf_dir)
    return MOD.estimate_coupons(MOD.label_band(_scored(t), 0.3), MOD.model_params(t.settings))


@register("fitted_curve_bound")
def q_fitted_curve_bound(spark, sf_dir):
    """The score at a campaign's target on its tenant's fitted curve."""
    t = Tables(spark, sf_dir)
    budgets = CAMP.upcoming_budget(t.campaigns_raw, A.AS_OF)
    return MOD.fitted_curve_bound(_scored(t), budgets, MOD.model_params(t.settings))


@register("bound_by_fit")
def q_bound_by_fit(spark, sf_dir):
    """M17 with the fitted curve."""
    t = Tables(spark, sf_dir)
    budgets = CAMP.upcoming_budget(t.campaigns_raw, A.AS_OF)
    return MOD.bound_assembly(_scored(t), budgets, MOD.model_params(t.settings), use_fit=True)


@register("mining_window", O.prefix() + f"""
SELECT l.web_id, l.uuid, l.session_id, l.ord FROM load l JOIN settings s ON s.web_id = l.web_id
WHERE CAST(l.date_time AS DATE) BETWEEN {_ASOF} - s.n_day_testing - s.n_day_mining AND {_ASOF} - s.n_day_testing""")
def q_mining_window(spark, sf_dir):
    """Load rows inside their tenant's training window."""
    t = Tables(spark, sf_dir)
    return MOD.mining_window(t.load, t.settings, A.AS_OF).select("web_id", "uuid", "session_id", "ord")


@register("upper_bound")
def q_upper_bound(spark, sf_dir):
    """M15 on the test part of the split."""
    t = Tables(spark, sf_dir)
    s = MOD.train_test_split(_scored(t), 0.3, 25).where(F.col("is_test") == 1)
    return MOD.upper_bound_at(s, MOD.model_params(t.settings), 50.0)


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    """Split of session features by digest."""
    return MOD.train_test_split(_session_features(Tables(spark, sf_dir)))


@register("train_model")
def q_train_model(spark, sf_dir):
    """M01 + M18 (rows-only): a model for each tenant of the settings and a 'default' model, from the training windows."""
    t = Tables(spark, sf_dir)
    sf = _session_features(t, within=lambda df: MOD.mining_window(df, t.settings, A.AS_OF))
    return MOD.train_models(sf, t.settings, MODEL_FEATURES)


@register("power_features", _FEAT_P + """
SELECT uuid, session_id, pow(CAST(pageviews AS DOUBLE), 0.5) AS pageviews,
  pow(CAST(time_pageview_total AS DOUBLE), 2.0) AS time_pageview_total FROM sf""")
def q_power_features(spark, sf_dir):
    """Feature power transform."""
    sf = _session_features(Tables(spark, sf_dir)).select("uuid", "session_id", "pageviews", "time_pageview_total")
    return MOD.power_transform(sf, {"pageviews": 0.5, "time_pageview_total": 2.0})


# ------------------------------------------------------- generic helpers
_EVX = "ex AS (SELECT event_id, ts, user_id, event_type, value FROM events)"


@register("moving_avg", f"WITH {_EVX} SELECT event_id, user_id, value, AVG(value) OVER "
          "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value_mavg FROM ex")
def q_moving_avg(spark, sf_dir):
    """Trailing 3-row mean of each user's event values."""
    ev = A.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return ORDR.moving_average(ev, ["user_id"], ["ts", "event_id"], "value", 3).select(
        "event_id", "user_id", "value", "value_mavg")


@register("block_avg", f"WITH {_EVX}, r AS (SELECT user_id, value, ROW_NUMBER() OVER "
          "(PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ex) "
          "SELECT user_id, CAST(floor((rn - 1) / 3) AS BIGINT) AS block, AVG(value) AS value_bavg FROM r "
          "GROUP BY user_id, floor((rn - 1) / 3) HAVING COUNT(*) = 3")
def q_block_avg(spark, sf_dir):
    """3-row block means, incomplete tail dropped."""
    ev = A.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return ORDR.block_average(ev, ["user_id"], ["ts", "event_id"], "value", 3).select(
        "user_id", F.col("block").cast("bigint").alias("block"), "value_bavg")


@register("nth_largest", f"WITH {_EVX} SELECT event_type, event_id, value FROM (SELECT *, ROW_NUMBER() OVER "
          "(PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM ex) WHERE rn = 5")
def q_nth_largest(spark, sf_dir):
    """The 5th largest value per event type."""
    ev = A.read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    r = ORDR.nth_largest(ev, ["event_type"], "value", ["event_id"])
    return r.where(F.col("_rank") == 5).select("event_type", "event_id", "value")


@register("latest_per_user", f"WITH {_EVX} SELECT user_id, arg_max(value, (ts, event_id)) AS value, "
          "arg_max(event_type, (ts, event_id)) AS event_type FROM ex GROUP BY user_id")
def q_latest_per_user(spark, sf_dir):
    """Latest value per key (max_by, no window)."""
    ev = A.read_table(spark, sf_dir, "events")
    return ORDR.last_non_null(ev, ["user_id"], ["value", "event_type"], ["ts", "event_id"])


@register("linear_fit", "SELECT event_type, regr_slope(value, CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS slope, "
          "regr_intercept(value, CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS intercept FROM events GROUP BY event_type")
def q_linear_fit(spark, sf_dir):
    """Least-squares line of value on k per event type."""
    ev = A.read_table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    return DES.linear_fit(ev, "k", "value", group=["event_type"])


_MIX = [(0.6, 10.0, 4.0), (0.4, 60.0, 15.0)]


@register("mixture_density", "SELECT event_id, c.component, c.f * (1.0 / c.s / sqrt(2 * pi())) * exp(-pow(value - c.xm, 2) / (2 * c.s * c.s)) AS density "
          "FROM events JOIN (VALUES " + ", ".join(f"({i}, {f}, {xm}, {s})" for i, (f, xm, s) in enumerate(_MIX))
          + ") c(component, f, xm, s) ON TRUE")
def q_mixture_density(spark, sf_dir):
    """Two-component Gaussian mixture densities of event values."""
    ev = A.read_table(spark, sf_dir, "events").select("event_id", "value")
    return DES.mixture_density(ev, "value", _MIX).select("event_id", "component", "density")


# ---------------------------------------------------- raw decode, flatten
from sparktrail.operators import flatten as FL  # noqa: E402
from sparktrail.plans import raw_adapter as RA  # noqa: E402
from sparktrail.sources import raw as RAW  # noqa: E402


def raw_events(spark, sf_dir, documents=RA.raw_documents):
    """Raw objects of tracker JSON derived from events, decoded."""
    objs = RA.raw_objects(A.base_events(spark, sf_dir), documents)
    docs = RAW.decode_objects(objs, keep=("path",))
    return docs.select(F.try_variant_get("ev", "$._ord", "bigint").alias("ord"), "path", "doc_pos", "ev")


@register("raw_decode", O.prefix() + """
SELECT strftime(ts, '%Y/%m/%d/%H/%M') AS path, CAST(COUNT(*) AS BIGINT) AS n_docs FROM ev GROUP BY 1""")
def q_raw_decode(spark, sf_dir):
    """Documents recovered per raw object."""
    return raw_events(spark, sf_dir).groupBy("path").agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"))


_OBJECT_SQL = f"strftime(ts, '%Y/%m/%d/%H/%M') AS path, ord // {RA.IDS_PER_OBJECT} AS part"


@register("raw_corrupt", O.prefix() + f"""
SELECT path FROM (SELECT {_OBJECT_SQL}, ord FROM ev) d GROUP BY path, part HAVING bool_or(ord % 50 = {RA.BROKEN})""")
def q_raw_corrupt(spark, sf_dir):
    """Objects with documents that would not decode (here those that repeat a key)."""
    return RAW.corrupt_objects(RA.raw_objects(A.base_events(spark, sf_dir), broken=True))


@register("raw_salvaged", O.prefix() + f"""
SELECT strftime(ts, '%Y/%m/%d/%H/%M') AS path, CAST(COUNT(*) AS BIGINT) AS n_docs FROM ev
WHERE ord % 50 <> {RA.BROKEN} GROUP BY 1""")
def q_raw_salvaged(spark, sf_dir):
    """Documents kept where others of their object can't be read."""
    docs = RAW.decode_objects(RA.raw_objects(A.base_events(spark, sf_dir), broken=True))
    return docs.groupBy("path").agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"))


def _flatten_query(et):
    def q(spark, sf_dir):
        raw = raw_events(spark, sf_dir)
        if et == "clicks":
            return FL.flatten_clicks(raw)
        settings = RA.product_settings(spark) if et == "purchase" else None
        return FL.flatten(raw, et, settings)
    q.__doc__ = f"P10 flatten of {et} events from decoded raw objects."
    return q


for _et in ("load", "leave", "timeout", "acceptCoupon", "enterCoupon", "purchase", "clicks"):
    register(f"flatten_{_et}", O.prefix() + "\n" + RA.expected_sql(_et))(_flatten_query(_et))


def _second_query(et):
    def q(spark, sf_dir):
        settings = RA.product_settings(spark) if et in ("addCart", "removeCart") else None
        return FL.flatten(raw_events(spark, sf_dir, RA.second_documents), et, settings)
    q.__doc__ = f"P10 flatten of {et} events from decoded raw objects."
    return q


for _et in ("addCart", "removeCart", "sendCoupon", "discardCoupon", "sendAfAd", "acceptAf", "acceptAd"):
    register(f"flatten_{_et}", O.prefix() + "\n" + RA.second_sql(_et))(_second_query(_et))


@register("criteria_filter", O.prefix() + """
SELECT CAST(COUNT(*) AS BIGINT) AS n FROM ev WHERE NOT (event_type = 'click' AND k % 2 = 1)
  AND event_type = 'view' AND NOT (k % 31 = 7)""")
def q_criteria_filter(spark, sf_dir):
    """events with web_id, event_type = 'load' and a 36-char uuid
    (F04 guard on the promoted column)."""
    raw = RAW.criteria_filter(raw_events(spark, sf_dir), {"web_id": None, "event_type": "load"})
    raw = raw.withColumn("uuid", F.try_variant_get("ev", "$.uuid", "string"))
    return FEA.uuid_guard(raw).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("fuzzy_filter", O.prefix() + """
SELECT CAST(COUNT(*) AS BIGINT) AS n FROM ev WHERE event_type = 'click' AND k % 2 = 1
  AND list_extract(['keyword_side_hot', 'keyword_side_footprint', 'keyword_search', 'keyword_word_hot',
   'keyword_word_other', 'sliding_click', 'guess_click', 'footprint_click', 'otherlike_click', 'onpage',
   'other_click'], (k % 11) + 1) LIKE '%keyword%'""")
def q_fuzzy_filter(spark, sf_dir):
    """event names containing 'keyword'."""
    raw = RAW.fuzzy_filter(raw_events(spark, sf_dir), {"event_type": "keyword"})
    return raw.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("price_clean", O.prefix() + """
SELECT ord, CASE WHEN regexp_matches(t, '^-?[0-9]+$') THEN CAST(t AS BIGINT)
  ELSE COALESCE(CAST(trunc(TRY_CAST(array_to_string(regexp_extract_all(t, '[0-9.]+'), '') AS DOUBLE)) AS BIGINT), -1) END AS price
FROM (SELECT ord, CASE k % 6 WHEN 0 THEN 'NT$' || CAST(k * 13 AS VARCHAR) || ',' || CAST(k % 10 AS VARCHAR) || '00'
  WHEN 1 THEN '-' || CAST(k AS VARCHAR) WHEN 2 THEN '-' || CAST(k AS VARCHAR) || '.5'
  WHEN 3 THEN 'abc' WHEN 4 THEN CAST(k AS VARCHAR) || '.99' ELSE '1.2.' || CAST(k AS VARCHAR) END AS t FROM ev)""")
def q_price_clean(spark, sf_dir):
    """P12 on price texts derived from events (covers the D02 shapes)."""
    ev = A.base_events(spark, sf_dir)
    k = F.col("k").cast("string")
    t = (F.when(F.col("k") % 6 == 0, F.concat(F.lit("NT$"), (F.col("k") * 13).cast("string"), F.lit(","),
                                               (F.col("k") % 10).cast("string"), F.lit("00")))
          .when(F.col("k") % 6 == 1, F.concat(F.lit("-"), k))
          .when(F.col("k") % 6 == 2, F.concat(F.lit("-"), k, F.lit(".5")))
          .when(F.col("k") % 6 == 3, F.lit("abc"))
          .when(F.col("k") % 6 == 4, F.concat(k, F.lit(".99")))
          .otherwise(F.concat(F.lit("1.2."), k)))
    from sparktrail.functions.scalars import price_to_int
    return ev.select("ord", price_to_int(t, -1).alias("price"))


@register("length_guard", O.prefix() + """
SELECT CAST(COUNT(*) AS BIGINT) AS n FROM ev WHERE length(CASE WHEN k % 31 = 7 THEN 'x' || uuid ELSE uuid END) <= 36""")
def q_length_guard(spark, sf_dir):
    """F03 over the raw uuid text."""
    raw = raw_events(spark, sf_dir).select(F.try_variant_get("ev", "$.uuid", "string").alias("uuid"))
    return FL.length_guard(raw).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("dedup_last", O.prefix() + """
SELECT web_id, uuid, session_id, arg_max(ord, ("timestamp", ord)) AS ord, max("timestamp") AS "timestamp"
FROM load GROUP BY web_id, uuid, session_id""")
def q_dedup_last(spark, sf_dir):
    """Keep the last load event per (web_id, uuid, session_id)."""
    t = Tables(spark, sf_dir)
    d = FL.dedup_last(t.load.select("web_id", "uuid", "session_id", "timestamp", "ord"),
                      ["web_id", "uuid", "session_id"], ["timestamp", "ord"])
    return d.select("web_id", "uuid", "session_id", "ord", "timestamp")


# --------------------------------------------- mutations, lookups, stream
from sparktrail.operators import lookups as LK  # noqa: E402
from sparktrail.operators import upsert as UP  # noqa: E402

_COUPON_COLS = [f"n_{m}_{t}" for t in ST.COUPON_TYPES for m in ("events", "uuid")]


@register("upsert_stats", O.prefix() + f", tr AS ({_TRACKER_SQL}), co AS ({_COUPON_SQL})\n"
          "SELECT * FROM tr FULL OUTER JOIN co USING (web_id, date)")
def q_upsert_stats(spark, sf_dir):
    """Tracker statistics upserted with coupon statistics (coupon
    columns only) - the reference's two upserts into one stat table."""
    tabs = _stat_tables(Tables(spark, sf_dir))
    return UP.upsert(ST.tracker_statistics(tabs), ST.coupon_statistics(tabs), ["web_id", "date"], _COUPON_COLS)


@register("replace_rows", O.prefix() + f", tr AS ({_TRACKER_SQL})\n"
          "SELECT * FROM tr WHERE date < DATE '2024-01-15' UNION ALL "
          "SELECT * REPLACE (n_events_load + 1 AS n_events_load, NULL AS n_uuid_load) FROM tr WHERE date >= DATE '2024-01-15'")
def q_replace_rows(spark, sf_dir):
    """Rows of later days replaced whole (a dropped column becomes null)."""
    tr = ST.tracker_statistics(_stat_tables(Tables(spark, sf_dir)))
    upd = (tr.where(F.col("date") >= F.lit("2024-01-15").cast("date"))
             .withColumn("n_events_load", F.col("n_events_load") + 1).drop("n_uuid_load"))
    return UP.replace_rows(tr, upd, ["web_id", "date"])


@register("update_rows", O.prefix() + f", tr AS ({_TRACKER_SQL})\n"
          "SELECT * REPLACE (CASE WHEN date >= DATE '2024-01-15' THEN n_events_load * 2 ELSE n_events_load END AS n_events_load) FROM tr")
def q_update_rows(spark, sf_dir):
    """Matched rows get the new column value; unmatched updates are
    ignored (never inserted)."""
    tr = ST.tracker_statistics(_stat_tables(Tables(spark, sf_dir)))
    upd = tr.where(F.col("date") >= F.lit("2024-01-15").cast("date")).select(
        "web_id", "date", (F.col("n_events_load") * 2).alias("n_events_load"))
    ghost = upd.withColumn("web_id", F.concat(F.lit("unknown-"), F.col("web_id")))
    return UP.update_rows(tr, upd.unionByName(ghost), ["web_id", "date"], ["n_events_load"])


@register("delete_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
          "WHERE NOT COALESCE(o_totalprice > 100000 AND NULLIF(o_custkey % 4, 0) > 1, FALSE)")
def q_delete_rows(spark, sf_dir):
    """Large orders of some customers deleted; where the condition is null the row stays."""
    orders = A.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return UP.delete_rows(orders, F.expr("o_totalprice > 100000 AND nullif(o_custkey % 4, 0) > 1"))


@register("upsert_last_order", """SELECT COALESCE(c_custkey, o_custkey) AS c_custkey, c_name,
  CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE last END AS c_acctbal
FROM customer FULL JOIN (SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last
  FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def q_upsert_last_order(spark, sf_dir):
    """K01 with many updates of one key: each customer's balance becomes the price of the last order."""
    target = A.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    updates = A.read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderdate", "o_orderkey")
    return UP.upsert(target, updates, ["c_custkey"], ["c_acctbal"], ["o_orderdate", "o_orderkey"]).select(*target.columns)


@register("date_helpers", """SELECT event_id, CAST(ts + INTERVAL 8 HOUR AS DATE) AS today, CAST(ts AS DATE) - 3 AS shifted,
  CAST(day(last_day(ts)) AS INTEGER) AS month_days, strftime(ts, '%Y/%m/%d %H') AS told,
  CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS number, CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
  date_trunc('second', ts) AS again FROM events""")
def q_date_helpers(spark, sf_dir):
    """C01, C03-C06, C08 on every event's time."""
    from sparktrail.functions import dates as D
    ts = F.col("ts").cast("timestamp_ntz")
    seconds = D.ts_to_seconds(ts)
    return A.read_table(spark, sf_dir, "events").select(
        "event_id", D.curdate(ts, 8).alias("today"), D.date_shift(F.to_date(ts), 3).alias("shifted"),
        D.days_of_month(F.to_date(ts)).alias("month_days"), D.datetime_to_str(ts, "yyyy/MM/dd HH").alias("told"),
        D.date_to_int(F.to_date(ts)).alias("number"), seconds.alias("seconds"), D.seconds_to_ts(seconds).alias("again"))


@register("events_by_period", """WITH p AS (SELECT TIMESTAMP '2024-01-01' + to_hours(CAST(i * 6 AS BIGINT)) AS date_time FROM range(0, 125) g(i))
SELECT p.date_time, CAST(COUNT(e.event_id) AS BIGINT) AS n FROM p
LEFT JOIN events e ON e.ts >= p.date_time AND e.ts < p.date_time + INTERVAL 6 HOUR GROUP BY p.date_time""")
def q_events_by_period(spark, sf_dir):
    """Events of each 6 hours of January, empty ones too."""
    from sparktrail.functions import dates as D
    ts = F.col("ts").cast("timestamp_ntz")
    start = F.timestamp_add("HOUR", (F.floor(F.hour(ts) / 6) * 6).cast("int"), F.to_date(ts).cast("timestamp_ntz"))
    n = A.read_table(spark, sf_dir, "events").groupBy(start.alias("date_time")).agg(F.count(F.lit(1)).alias("n"))
    return D.datetime_range(spark, "2024-01-01", 31, 6).join(n, "date_time", "left").select(
        "date_time", F.coalesce("n", F.lit(0)).alias("n"))


def _raw_zone(spark, sf_dir):
    """The raw zone of all events in a scratch folder."""
    import uuid as _uuid

    from sparktrail.session import scratch_path
    root = scratch_path(spark, f"raw-{_uuid.uuid4().hex[:8]}")
    RAW.land_raw(RAW.with_event_fields(raw_events(spark, sf_dir)), root)
    return root


@register("raw_retained", O.prefix() + f"""
SELECT CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour, CAST(COUNT(*) AS BIGINT) AS n FROM ev
WHERE CAST(ts AS DATE) >= {_ASOF} - 10 GROUP BY ALL""")
def q_raw_retained(spark, sf_dir):
    """Documents of the raw zone by hour after days of more than 10 days ago are deleted."""
    root = _raw_zone(spark, sf_dir)
    RAW.drop_expired(spark, root, A.AS_OF, 10)
    return RAW.read_raw(spark, root).groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n"))


@register("raw_local_day", O.prefix() + """
SELECT web_id, event_type, CAST(COUNT(*) AS BIGINT) AS n FROM ev
WHERE ts >= TIMESTAMP '2024-01-09 16:00:00' AND ts < TIMESTAMP '2024-01-11 16:00:00' GROUP BY ALL""")
def q_raw_local_day(spark, sf_dir):
    """Documents of two local days (UTC+8), read by partition."""
    days = RAW.local_day(RAW.read_raw(spark, _raw_zone(spark, sf_dir)), "2024-01-10", "2024-01-11")
    ev = A.base_events(spark, sf_dir).select("ord", "event_type")
    return (days.select("ord", F.col("ev").alias("doc")).join(ev, "ord")
                .groupBy(F.try_variant_get("doc", "$.web_id", "string").alias("web_id"), "event_type")
                .agg(F.count(F.lit(1)).alias("n")))


@register("tenant_rows", O.prefix() + """
, u AS (SELECT 'load' AS role, web_id FROM t_load UNION ALL SELECT 'purchase', web_id FROM t_purchase
  UNION ALL SELECT 'addCart', web_id FROM t_addCart UNION ALL SELECT 'removeCart', web_id FROM t_removeCart),
chosen AS (SELECT 'w' || CAST(s_suppkey AS VARCHAR) AS web_id FROM supplier WHERE s_suppkey % 4 <> 3)
SELECT u.role, u.web_id, CAST(COUNT(*) AS BIGINT) AS n, (SELECT COUNT(*) FROM t_load l WHERE l.web_id = u.web_id) AS n_load
FROM u JOIN chosen USING (web_id) WHERE web_id IN (SELECT web_id FROM t_load) GROUP BY u.role, u.web_id""")
def q_tenant_rows(spark, sf_dir):
    """Rows of each role of a list of tenants that have loads, with their number of loads."""
    t = Tables(spark, sf_dir)
    tenants = CAMP.tenant_selection(A.supplier_settings(spark, sf_dir), "addfan")
    return FEA.collect_tenants(A.tracker_tables(t.ev), tenants).groupBy("role", "web_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_load").alias("n_load"))


@register("latest_events", O.prefix() + """
SELECT * FROM (SELECT web_id, uuid, session_id, "timestamp", ord FROM load WHERE web_id = 'w1' ORDER BY ord DESC LIMIT 5)""")
def q_latest_events(spark, sf_dir):
    """Latest 5 load events of a tenant (top-k is the feature)."""
    t = Tables(spark, sf_dir)
    return LK.latest_events(t.load.select("web_id", "uuid", "session_id", "timestamp", "ord"), "w1", 5)


@register("hour_range_events", O.prefix() + """
SELECT * FROM (SELECT web_id, uuid, session_id, ord, date_time FROM load WHERE web_id = 'w2'
  AND date_time BETWEEN TIMESTAMP '2024-01-05 10:00:00' AND TIMESTAMP '2024-01-05 11:00:00' ORDER BY ord LIMIT 5)""")
def q_hour_range_events(spark, sf_dir):
    """F16: first 5 clean events of a tenant in one local hour."""
    t = Tables(spark, sf_dir)
    return LK.hour_events(t.load.select("web_id", "uuid", "session_id", "ord", "date_time"), "2024-01-05", 10, "w2", 5)


@register("local_events", O.prefix() + """
SELECT ord FROM (SELECT ord FROM ev WHERE web_id = 'w3' AND event_type = 'purchase' ORDER BY ord LIMIT 3)""")
def q_local_events(spark, sf_dir):
    """first raw purchase events of a tenant."""
    return LK.local_events(raw_events(spark, sf_dir), "w3", "purchase", 3).select("ord")


@register("tenant_status", _D + """
SELECT web_id, enable_analysis, enable_tracking, enable_addfan, platform FROM settings""")
def q_tenant_status(spark, sf_dir):
    """tenant status projection."""
    return CAMP.tenant_status(A.supplier_settings(spark, sf_dir))


@register("tenant_selection", _D + "\nSELECT web_id FROM settings WHERE enable_addfan = 1")
def q_tenant_selection(spark, sf_dir):
    """addfan-enabled tenants."""
    return CAMP.tenant_selection(A.supplier_settings(spark, sf_dir), "addfan")


@register("stream_ingest_load", O.prefix() + "\n" + RA.expected_sql("load"))
def q_stream_ingest_load(spark, sf_dir):
    """Raw objects derived from events are written as files, a
    Structured Streaming query ingests them (availableNow) through the same
    decode + flatten functions; the landed load table must equal the batch
    flatten."""
    import uuid as _uuid

    from sparktrail.session import scratch_path
    from sparktrail.streaming.ingest import start_ingest
    base = scratch_path(spark, f"stream-{_uuid.uuid4().hex[:8]}")
    RA.raw_objects(A.base_events(spark, sf_dir)).select("text").write.text(f"{base}/objects")
    q = start_ingest(spark, f"{base}/objects", f"{base}/_checkpoint", f"{base}/clean", ["load"], wholetext=False,
                     slot_hours=24)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/clean/load").drop("date", "slot", "batch_id")


@register("refresh_stats", O.prefix() + f", tr AS ({_TRACKER_SQL}), co AS ({_COUPON_SQL})\n"
          "SELECT * FROM tr FULL OUTER JOIN co USING (web_id, date) WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-11'")
def q_refresh_stats(spark, sf_dir):
    """Statistics recomputed only for the (tenant, day) pairs a
    batch touched (here: events of Jan 10-11)."""
    from sparktrail.streaming.ingest import refresh_statistics, touched_days
    t = Tables(spark, sf_dir)
    tabs = _stat_tables(t)
    batch = t.load.where(F.to_date("date_time").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-11").cast("date")))
    return refresh_statistics(tabs, touched_days(batch))


from sparktrail.plans import ingest_queries, model_oracles, more_queries  # noqa: E402,F401  (register their own)
