"""Driver-table adapters: derive the tracker's clean event tables from the
generated ``events`` table (and lineitem/orders), so every registered query
reads the given tables and its work grows with them.

The same mapping is spelled twice: as DataFrame code here and as DuckDB SQL
in ``plans.oracle`` (the correctness oracle).

Mapping (one events row = one tracker event):
  k            int(props.k)
  web_id       'w' || user_id % 5          (a visitor has one tenant)
  uuid         lpad(user_id, 36, '0')
  session_id   user_id || '-' || date(ts)  (one session per visitor-day)
  timestamp    epoch ms of ts; date_time = ts
  view -> load / sendAfAd, signup -> acceptCoupon / acceptAf / addCart,
  error -> discardCoupon / timeout, click -> enterCoupon / banner click /
  acceptAd / leave, purchase -> purchase; every row -> sendCoupon.
  removeCart = error rows with even k.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktrail.functions.dates import _epoch, epoch_ms

N_TENANTS = 5
N_COUPONS_PER_TENANT = 7

# Fixed evaluation date of the adapter queries (parameter, never current_date()).
AS_OF = _dt.datetime(2024, 1, 20, 0, 0, 0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; splits follow ``spark.sql.files.*`` of the session."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id").cast("string")
    return ev.select(
        F.col("event_id").alias("ord"),
        "ts", "user_id", "event_type", "value",
        k.alias("k"),
        F.concat(F.lit("w"), (F.col("user_id") % N_TENANTS).cast("string")).alias("web_id"),
        F.lpad(uid, 36, "0").alias("uuid"),
        F.concat(uid, F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        epoch_ms("ts").alias("timestamp"),
        F.col("ts").alias("date_time"),
    )


def _coupon_id():
    return (F.col("user_id") % N_TENANTS) * N_COUPONS_PER_TENANT + F.col("k") % N_COUPONS_PER_TENANT


def _code():
    return F.concat(F.lit("c"), (F.col("k") % N_COUPONS_PER_TENANT).cast("string"))


UNIVERSAL = ["web_id", "uuid", "session_id", "timestamp", "date_time", "ord"]


def load(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "view").select(
        *UNIVERSAL,
        (F.col("k") % 3).alias("device"),
        (F.col("k") % 4).alias("landing_count"),
        F.when(F.col("user_id") % 4 == 0, 1).otherwise(0).alias("is_purchased_before"),
        (1 + F.col("k") % 10).alias("pageviews"),
        (F.col("k") % 17).alias("click_count_total"),
        F.col("value").alias("time_pageview_total"),
    )


def accept(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "signup").select(
        *UNIVERSAL, _coupon_id().alias("coupon_id"), _code().alias("coupon_code"),
        F.concat(F.lit("L"), _coupon_id().cast("string")).alias("link_code"))


def discard(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "error").select(
        *UNIVERSAL, _coupon_id().alias("coupon_id"), _code().alias("coupon_code"))


def send(ev: DataFrame) -> DataFrame:
    return ev.select(*UNIVERSAL, _coupon_id().alias("coupon_id"))


def enter(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "click").select(*UNIVERSAL, _code().alias("coupon_code"))


def _order_hour():
    return F.timestamp_add("HOUR", F.timestamp_diff("HOUR", _epoch(), F.col("ts")), _epoch())


def _line_columns() -> dict:
    qty = 1 + F.col("k") % 3
    price = F.col("value").cast("decimal(18,2)")
    return {
        "product_price": price, "product_quantity": qty,
        "total_price": F.when(F.col("k") % 4 == 0, F.lit(-1).cast("decimal(18,2)")).otherwise(
            (price * qty).cast("decimal(18,2)")),
        "coupon": F.when(F.col("k") % 2 == 0, _code()).otherwise((F.col("k") % 5).cast("string")),
        "avivid_coupon": F.when(F.col("k") % 2 == 1, "1").otherwise("0"),
        "shipping_price": F.when(F.col("k") % 5 == 0, F.lit(0)).otherwise(F.col("k") % 9 * 10).cast("decimal(18,2)"),
        "product_id": F.concat(F.lit("p"), (F.col("k") % 13).cast("string"))}


def purchase(ev: DataFrame) -> DataFrame:
    """Purchase lines; lines of one visitor-hour share the order timestamp."""
    hour = _order_hour()
    return ev.where(F.col("event_type") == "purchase").select(
        "web_id", "uuid", "session_id", "ord", epoch_ms(hour).alias("timestamp"), hour.alias("date_time"),
        *[v.alias(c) for c, v in _line_columns().items()])


def tagged(ev: DataFrame) -> DataFrame:
    """Accepts, discards, entries and purchase lines (``attribution.tag_events``) in one pass over the events."""
    et = F.col("event_type")
    role = (F.when(et == "signup", "accept").when(et == "error", "discard").when(et == "click", "enter")
             .when(et == "purchase", "purchase"))
    order = et == "purchase"
    hour, line = _order_hour(), _line_columns()
    return ev.where(role.isNotNull()).select(
        role.alias("role"), "web_id", "uuid", "session_id", "ord",
        F.when(order, hour).otherwise(F.col("date_time")).alias("date_time"),
        F.when(order, epoch_ms(hour)).alias("timestamp"),
        F.when(et.isin("signup", "error"), _coupon_id()).alias("coupon_id"),
        F.when(et.isin("signup", "click"), _code()).alias("coupon_code"),
        *[F.when(order, line[c]).alias(c) for c in ("coupon", "avivid_coupon", "product_price", "product_quantity",
                                                     "total_price")])


def clicks(ev: DataFrame) -> DataFrame:
    """Banner clicks (the P09 output shape)."""
    return ev.where(F.col("event_type") == "click").select(
        *UNIVERSAL, (F.col("k") % 11).alias("recommend_type"))


def ad_accept_af(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "signup").select(*UNIVERSAL, _coupon_id().alias("ad_id"))


def ad_accept_ad(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "click").select(*UNIVERSAL, _coupon_id().alias("ad_id"))


def ad_send(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "view").select(*UNIVERSAL, _coupon_id().alias("ad_id"))


def simple_role(ev: DataFrame, event_type: str, extra_filter=None) -> DataFrame:
    df = ev.where(F.col("event_type") == event_type)
    if extra_filter is not None:
        df = df.where(extra_filter)
    return df.select(*UNIVERSAL, F.when(F.col("k") % 4 == 0, 1).otherwise(0).alias("is_purchased_before"))


def tracker_tables(ev: DataFrame) -> dict[str, DataFrame]:
    """The six tables of the tracker statistics."""
    pur = ev.where(F.col("event_type") == "purchase").select(
        *UNIVERSAL, F.when(F.col("k") % 4 == 0, 1).otherwise(0).alias("is_purchased_before"))
    return {
        "load": simple_role(ev, "view"),
        "leave": simple_role(ev, "click"),
        "timeout": simple_role(ev, "error"),
        "addCart": simple_role(ev, "signup"),
        "removeCart": simple_role(ev, "error", F.col("k") % 2 == 0),
        "purchase": pur,
    }


def batch_codes(ev: DataFrame):
    """(addfan_coupon sent codes, accepted codes) for the batch-coupon release."""
    code = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("k").cast("string"))
    link = F.concat(F.lit("L"), _coupon_id().cast("string"))
    sent = ev.where(F.col("event_type") == "view").select(
        "web_id", link.alias("link_code"), code.alias("coupon_code"),
        F.lit(1).alias("is_sent"), F.col("ts").alias("update_time"))
    acc = ev.where(F.col("event_type") == "signup").select(
        "web_id", "uuid", link.alias("link_code"), code.alias("coupon_code"), "date_time")
    return sent, acc


# ---------------------------------------------------------------- dimensions
# Campaign rows are generated by a rule over (tenant t, slot j).

def campaign_rows() -> list[tuple]:
    rows = []
    base = _dt.date(2024, 1, 1)
    for t in range(N_TENANTS):
        for j in range(N_COUPONS_PER_TENANT):
            cid = t * N_COUPONS_PER_TENANT + j
            start = base + _dt.timedelta(days=(cid * 3) % 12)
            end = start + _dt.timedelta(days=4 + (cid * 5) % 20)
            limit = ["none", "type=1&limit-bill=20", "limit-bill=50"][j % 3]
            rows.append((
                cid, f"w{t}", f"L{cid}", limit, j % 5, str(6 + j % 4), start, end,
                100 + 10 * j, 0 if j % 3 == 0 else 5 * j, j % 3,
                0 if cid % 11 == 10 else 1, 0 if j == 6 else 1, 1 if j % 2 == 0 else 0,
                1 if cid == 20 else 0,
                _dt.datetime.combine(end, _dt.time(12, 0)),
                "_" if j % 2 == 0 else f"img{cid}",
                f"https://a/{cid}", f"https://a/{cid}" if cid % 2 == 0 else f"https://b/{cid}",
            ))
    return rows


CAMPAIGN_SCHEMA = (
    "id BIGINT, web_id STRING, link_code STRING, coupon_limit STRING, coupon_type INT, "
    "coupon_amount STRING, start_time DATE, end_time DATE, coupon_total BIGINT, coupon_used BIGINT, "
    "coupon_code_mode INT, activity_enable INT, coupon_enable INT, ad_enable INT, activity_delete INT, "
    "update_time TIMESTAMP_NTZ, ad_image_url STRING, ad_url STRING, ad_btn_url STRING")


def campaigns(spark: SparkSession) -> DataFrame:
    """addfan_activity (dimension, 35 rows)."""
    return spark.createDataFrame(campaign_rows(), CAMPAIGN_SCHEMA)


def addfan_stat_rows() -> list[tuple]:
    return [(f"w{t}", 60 + 10 * t, 500 + 100 * t) for t in range(N_TENANTS)]


def addfan_stat(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(addfan_stat_rows(),
                                 "web_id STRING, avg_shipping_price INT, avg_total_price INT")


def settings_rows(cells: dict[str, tuple[int, int]] | None = None) -> list[tuple]:
    """cdp_tracking_settings rows; ``cells`` maps web_id -> (tt, cc)."""
    rows = []
    for t in range(N_TENANTS):
        w = f"w{t}"
        tt, cc = (cells or {}).get(w, (0, 0))
        rows.append((w, tt, cc, 1, 1, 1 if t != 3 else 0, "91" if t % 2 == 0 else "shopline",
                     7, 14, 0.3, 0.1 + 0.05 * t, 1.0 + t * 0.5,
                     "device,pageviews,click_count_total,landing_count,time_pageview_total",
                     "0.2,0.15,0.01,-0.3,0.002", -2.0 + 0.1 * t))
    return rows


SETTINGS_SCHEMA = (
    "web_id STRING, type_total_price INT, type_cal_cost INT, enable_analysis INT, enable_tracking INT, "
    "enable_addfan INT, platform STRING, n_day_testing INT, n_day_mining INT, test_size DOUBLE, "
    "lower_bound DOUBLE, n_weight DOUBLE, model_key STRING, model_value STRING, model_intercept DOUBLE")


def settings(spark: SparkSession, cells=None) -> DataFrame:
    return spark.createDataFrame(settings_rows(cells), SETTINGS_SCHEMA)


MIXED_CELLS = {"w0": (0, 0), "w1": (0, 2), "w2": (1, 1), "w3": (0, 4), "w4": (1, 5)}


# ------------------------------------------- dimensions that grow with the data
# A campaign for each part, and settings and averages for each supplier (as
# tenant). The rules are SQL that both engines read.

def _campaign_rules(timestamp: str) -> dict[str, str]:
    start = "DATE '2024-01-01' + CAST(p_partkey % 12 AS INT)"
    end = f"{start} + CAST(4 + p_partkey % 20 AS INT)"
    return {
        "id": "p_partkey",
        "web_id": "'w' || CAST(1 + p_partkey % 10 AS STRING)",
        "link_code": "'L' || CAST(p_partkey AS STRING)",
        "coupon_limit": "CASE p_partkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'type=1&limit-bill=20' ELSE 'limit-bill=50' END",
        "coupon_type": "CAST(p_size % 5 AS INT)",
        "coupon_amount": "CAST(6 + p_partkey % 4 AS STRING)",
        "start_time": start,
        "end_time": end,
        "coupon_total": "CAST(100 + p_partkey % 70 AS BIGINT)",
        "coupon_used": "CAST(CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey % 30 END AS BIGINT)",
        "activity_enable": "CASE WHEN p_partkey % 11 = 10 THEN 0 ELSE 1 END",
        "coupon_enable": "CASE WHEN p_partkey % 7 = 6 THEN 0 ELSE 1 END",
        "ad_enable": "CASE WHEN p_partkey % 5 = 4 THEN 0 ELSE 1 END",
        "activity_delete": "CASE WHEN p_partkey % 13 = 5 THEN 1 ELSE 0 END",
        "update_time": f"CAST({end} AS {timestamp})",
        "ad_image_url": "CASE WHEN p_partkey % 2 = 0 THEN '_' ELSE 'img' END",
        "ad_url": "'https://a/' || CAST(p_partkey AS STRING)",
        "ad_btn_url": "'https://b/' || CAST(p_partkey AS STRING)",
    }


SUPPLIER_SETTINGS = {
    "web_id": "'w' || CAST(s_suppkey AS STRING)",
    "type_total_price": "CAST(s_suppkey % 2 AS INT)",
    "type_cal_cost": "CAST(s_suppkey % 6 AS INT)",
    "enable_analysis": "CAST(CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 END AS INT)",
    "enable_tracking": "CAST(s_suppkey % 2 AS INT)",
    "enable_addfan": "CAST(CASE WHEN s_suppkey % 4 = 3 THEN 0 ELSE 1 END AS INT)",
    "platform": "CASE WHEN s_suppkey % 2 = 0 THEN '91' ELSE 'shopline' END",
    "model_value": "CASE WHEN s_suppkey % 5 = 0 THEN '_' WHEN s_suppkey % 7 = 0 THEN NULL ELSE '0.2' END",
}
SUPPLIER_STAT = {
    "web_id": "'w' || CAST(s_suppkey AS STRING)",
    "avg_shipping_price": "CAST(60 + s_suppkey % 40 AS INT)",
    "avg_total_price": "CAST(500 + s_nationkey * 10 AS INT)",
}


def _by_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(rule).alias(c) for c, rule in rules.items()])


def part_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_rules(read_table(spark, sf_dir, "part"), _campaign_rules("TIMESTAMP_NTZ"))


def supplier_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_rules(read_table(spark, sf_dir, "supplier"), SUPPLIER_SETTINGS)


def supplier_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_rules(read_table(spark, sf_dir, "supplier"), SUPPLIER_STAT)


def dimension_sql() -> str:
    """The same dimensions as common table expressions."""
    def cte(name, source, rules):
        return f"{name} AS (SELECT " + ", ".join(f"{r} AS {c}" for c, r in rules.items()) + f" FROM {source})"
    return ",\n".join([cte("campaigns", "part", _campaign_rules("TIMESTAMP")),
                       cte("settings", "supplier", SUPPLIER_SETTINGS), cte("addfan_stat", "supplier", SUPPLIER_STAT)])
