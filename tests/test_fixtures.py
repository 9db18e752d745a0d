"""Hand-derived cases (FIXTURES.md section D) on tiny inline DataFrames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_d01_decode(spark):
    from sparktrail.sources.raw import decode_objects
    objs = spark.createDataFrame([("a", '{"e":1}{"e":2}"landing"{"e":3}"]"')], "path string, text string")
    got = decode_objects(objs).select(F.try_variant_get("ev", "$.e", "int").alias("e")).orderBy("e")
    assert [r.e for r in got.collect()] == [1, 2, 3]


def test_d01_corrupt_object_is_reported_not_fatal(spark):
    from sparktrail.sources.raw import corrupt_objects, decode_objects
    objs = spark.createDataFrame([("a", '{"e":1}'), ("b", "{broken")], "path string, text string")
    assert decode_objects(objs).count() == 1
    assert [r.path for r in corrupt_objects(objs).collect()] == ["b"]


def test_d02_price(spark):
    from sparktrail.functions.scalars import price_to_int
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["NT$1,280", "-5", "-5.5", "abc", "12.99", "1.2.3"])],
                               "i int, t string")
    got = [r.p for r in df.orderBy("i").select(price_to_int(F.col("t"), -1).alias("p")).collect()]
    assert got == [1280, -5, 5, -1, 12, -1]


def _raw(spark, evs):
    return spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(evs)], "ord long, j string") \
                .select("ord", F.parse_json("j").alias("ev"))


U = "u" * 36


def test_d03_clicks(spark):
    from sparktrail.operators.flatten import flatten_clicks
    raw = _raw(spark, [
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "sliding_click", "click_info": {"type": 1}},
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "keyword_search", "click_info": {}},
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "unknown", "click_info": {}}])
    assert rows(flatten_clicks(raw).orderBy("ord"), "ord", "recommend_type") == [(0, 6), (1, 2)]


def _purchase_settings(spark):
    return spark.createDataFrame([("w", "purchase", "order_id,items.id,items.price", "order_id,product_id,product_price")],
                                 "web_id string, event_type string, keys string, renames string")


def test_d04_d05_products(spark):
    from sparktrail.operators.flatten import flatten
    raw = _raw(spark, [
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "purchase",
         "purchase": json.dumps({"order_id": "A1", "items": [{"id": "x", "price": 10}, {"id": "y"}]})},
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "purchase",
         "purchase": json.dumps({"order_id": "A2", "items": [{"id": "hitobp:product9", "price": 1},
                                                             {"id": "pufii:product:p0012", "price": 2},
                                                             {"id": "wstyle:product:77", "price": 3},
                                                             {"id": "p5", "price": 4}]})}])
    got = rows(flatten(raw, "purchase", _purchase_settings(spark)).orderBy("ord", "product_price"),
               "order_id", "product_id", "product_price")
    assert got == [("A1", "y", -1), ("A1", "x", 10), ("A2", "P0012", 2), ("A2", "77", 3), ("A2", "p5", 4)]


def test_d06_missing_vs_null(spark):
    from sparktrail.operators.flatten import flatten
    raw = _raw(spark, [
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "load", "load": {"dv": 1}},
        {"web_id": "w", "uuid": U, "ga_id": None, "timestamp": 1, "event_type": "load", "load": {"dv": 1}}])
    assert rows(flatten(raw, "load"), "ord", "ga_id", "url_last") == [(0, "_", "-1")]


def test_d07_record_user(spark):
    from sparktrail.operators.flatten import flatten
    raw = _raw(spark, [
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "leave"},
        {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "leave", "record_user": json.dumps({"dv": 1})}])
    got = rows(flatten(raw, "leave").orderBy("ord"), "device", "pageviews")
    assert got == [("-1", "-1"), ("1", "-1")]


def test_d08_length_guard(spark):
    from sparktrail.operators.flatten import flatten
    raw = _raw(spark, [{"web_id": "w", "uuid": "u" * 37, "timestamp": 1, "event_type": "leave"},
                       {"web_id": "w", "uuid": U, "timestamp": 1, "event_type": "leave"}])
    assert rows(flatten(raw, "leave"), "ord") == [(1,)]


def test_d09_hour_slice_shifts_to_utc(spark):
    from sparktrail.sources.raw import hour_slice
    raw = spark.createDataFrame([(dt.date(2021, 12, 31), 19), (dt.date(2022, 1, 1), 3)], "dt date, hour int")
    assert rows(hour_slice(raw, "2022-01-01", 3, utc=8), "dt", "hour") == [(dt.date(2021, 12, 31), 19)]


def test_d10_epoch_to_local(spark):
    from sparktrail.functions.dates import ms_to_local
    got = spark.range(1).select(ms_to_local(F.lit(1642521611326), 8).alias("t")).first().t
    assert got == dt.datetime(2022, 1, 19, 0, 0, 11, 326000)


def test_d11_order_revenue(spark):
    from sparktrail.operators.orders import order_revenue
    df = spark.createDataFrame([("w", "u", "s", 1, 1, -1.0, 10.0, 2), ("w", "u", "s", 1, 2, 100.0, 0.0, 0),
                                ("w", "u", "s", 1, 3, -1.0, 5.0, 1)],
                               "web_id string, uuid string, session_id string, timestamp long, ord long, "
                               "total_price double, product_price double, product_quantity int")
    assert order_revenue(df).first().revenue == 105


def test_d12_banner_waterfall(spark):
    from sparktrail.operators.banners import banner_revenue
    clicks = spark.createDataFrame([("d", "w", "u", "s", 3), ("d", "w", "u", "s", 1)],
                                   "date string, web_id string, uuid string, session_id string, recommend_type int")
    pur = spark.createDataFrame([("d", "w", "u", "s", 1, 1, 50.0, 0.0, 1)],
                                "date string, web_id string, uuid string, session_id string, timestamp long, ord long, "
                                "total_price double, product_price double, product_quantity int")
    got = rows(banner_revenue(pur, clicks).orderBy("recommend_type"),
               "recommend_type", "revenue", "clicks", "sessions", "transaction")
    assert got == [(1, 50.0, 1, 1, 1), (3, 0.0, 1, 1, 0)]


def test_d13_d14_cost_and_budget(spark):
    from sparktrail.operators.campaigns import remaining_budget
    df = spark.createDataFrame([(100, 40, dt.date(2024, 1, 26)), (100, 40, dt.date(2024, 1, 20)),
                                (100, 40, dt.date(2024, 1, 18))],
                               "coupon_total long, coupon_used long, activity_end date")
    got = [r.avg_n_coupon for r in remaining_budget(df, "2024-01-20").collect()]
    assert got == [10.0, 0.0, -30.0]
    cost = spark.range(1).select(F.floor(F.floor(F.lit(999.0)) * (10 - F.lit(9.0)) / 10).alias("c")).first().c
    assert cost == 99


def test_d15_min_spend(spark):
    from sparktrail.functions.scalars import min_spend
    df = spark.createDataFrame([("x&limit-bill=800",), ("none",)], "c string")
    assert [r.m for r in df.select(min_spend(F.col("c")).alias("m")).collect()] == [800, 0]


def test_d16_stale_coupons(spark):
    from sparktrail.operators.campaigns import stale_coupons
    df = spark.createDataFrame([(i, "w", s, dt.date(2024, 2, 1), 0, "_", 0, 1, 1)
                                for i, s in enumerate([dt.date(2024, 1, 15), dt.date(2024, 1, 1), dt.date(2024, 1, 19)])],
                               "id long, web_id string, start_time date, end_time date, coupon_used long, "
                               "ad_image_url string, activity_delete int, coupon_enable int, activity_enable int")
    assert rows(stale_coupons(df, "2024-01-20").orderBy("id"), "id", "unused_days") == [(0, 4), (1, 10)]


def test_d17_ad_growth(spark):
    from sparktrail.operators.ads import ad_growth
    t = dt.datetime(2024, 1, 5, 10)
    ev = spark.createDataFrame([("w", 1, "u1", t)], "web_id string, ad_id long, uuid string, date_time timestamp_ntz")
    ads = spark.createDataFrame([(1, "w", dt.date(2024, 1, 1), dt.date(2024, 1, 10), "a", "a")],
                                "id long, web_id string, activity_start date, activity_end date, ad_url string, ad_btn_url string")
    got = ad_growth(ev, ev, ev.limit(0), ads).first()
    assert (got.addfan_growth, got.addfan_impression) == (2, 0)


def test_d18_coupon_release(spark):
    from sparktrail.operators.coupons import coupon_release
    t0 = dt.datetime(2024, 1, 20, 12)
    sent = spark.createDataFrame([("w", "L", c, 1, t0 - dt.timedelta(hours=h)) for c, h in [("c1", 3), ("c2", 3), ("c3", 1)]],
                                 "web_id string, link_code string, coupon_code string, is_sent int, update_time timestamp_ntz")
    acc = spark.createDataFrame([("w", "L", "c1")], "web_id string, link_code string, coupon_code string")
    camp = spark.createDataFrame([("w", "L")], "web_id string, link_code string")
    assert rows(coupon_release(sent, acc, camp, t0), "coupon_code") == [("c2",)]


def test_d19_session_flags(spark):
    from sparktrail.operators.features import session_flags
    load = spark.createDataFrame([("u1", "s-1"), ("u1", "s-2")], "uuid string, session_id string")
    pur = spark.createDataFrame([("u1", "s-1", 1, 1), ("u1", "s-2", 2, 2)],
                                "uuid string, session_id string, timestamp long, ord long")
    exact = rows(session_flags(load, {"f": pur}, "any_exact").orderBy("session_id"), "f")
    last = rows(session_flags(load, {"f": pur}, "last_contains").orderBy("session_id"), "f")
    assert exact == [(1,), (1,)] and last == [(0,), (1,)]


def test_d20_last_non_null(spark):
    from sparktrail.operators.ordered import last_non_null
    df = spark.createDataFrame([("u", 1, 3), ("u", 2, None)], "uuid string, timestamp long, pageviews int")
    assert last_non_null(df, ["uuid"], ["pageviews"], ["timestamp"]).first().pageviews == 3


@pytest.mark.parametrize("avg,expected", [(2, 0.8), (9, 0.6), (0.3, 0.5)])
def test_d21_rank_bound(spark, avg, expected):
    from sparktrail.operators.model import traffic_and_rank_bound
    scored = spark.createDataFrame([("w", f"u{i}", p, pv) for i, (p, pv) in
                                    enumerate([(.9, 2), (.8, 2), (.7, 2), (.6, 2), (.5, 1)])],
                                   "web_id string, uuid string, prob double, pageviews int")
    budgets = spark.createDataFrame([(1, "w", float(avg))], "id long, web_id string, avg_n_coupon double")
    params = spark.createDataFrame([("w", 1.0, 1.0, -2.0)], "web_id string, n_day double, n_weight double, _b double")
    got = traffic_and_rank_bound(scored, budgets, params).first().lower_bound
    assert got == pytest.approx(expected)


def test_d22_floor(spark):
    from sparktrail.operators.model import traffic_and_rank_bound
    scored = spark.createDataFrame([("w", "u0", .11, 2)], "web_id string, uuid string, prob double, pageviews int")
    budgets = spark.createDataFrame([(1, "w", 1.0)], "id long, web_id string, avg_n_coupon double")
    params = spark.createDataFrame([("w", 1.0, 1.0, -2.0)], "web_id string, n_day double, n_weight double, _b double")
    assert traffic_and_rank_bound(scored, budgets, params).first().lower_bound == pytest.approx(0.13112, abs=1e-5)


def test_d23_histogram(spark):
    from sparktrail.operators.describe import histogram
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "x double")
    assert [r["count"] for r in histogram(df, "x", 2).orderBy("bin").collect()] == [1, 2]


def test_d24_moving_and_block_average(spark):
    from sparktrail.operators.ordered import block_average, moving_average
    df = spark.createDataFrame([("k", i, float(i)) for i in range(1, 5)], "k string, o int, v double")
    ma = [r.v_mavg for r in moving_average(df, ["k"], ["o"], "v", 2).orderBy("o").collect()]
    assert ma == [1.0, 1.5, 2.5, 3.5]
    df7 = spark.createDataFrame([("k", i, float(i)) for i in range(1, 8)], "k string, o int, v double")
    assert [r.v_bavg for r in block_average(df7, ["k"], ["o"], "v", 3).orderBy("block").collect()] == [2.0, 5.0]


def test_d25_coupon_coercion(spark):
    from sparktrail.functions.scalars import coupon_number
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["ABC", "12abc", "-30", "0"])], "i int, c string")
    got = [r.b for r in df.orderBy("i").select((coupon_number(F.col("c")) != 0).alias("b")).collect()]
    assert got == [False, True, True, False]


def test_d26_upserts(spark):
    from sparktrail.operators.upsert import replace_rows, update_rows, upsert
    target = spark.createDataFrame([(1, "a", "b")], "k int, first string, second string")
    upd = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "k int, first string, second string")
    assert rows(upsert(target, upd, ["k"], ["first"]).orderBy("k"), "k", "first", "second") == [(1, "x", "b"), (2, "y", "z")]
    assert rows(replace_rows(target, upd, ["k"]).orderBy("k"), "k", "first", "second") == [(1, "x", None), (2, "y", "z")]
    assert rows(update_rows(target, upd, ["k"], ["first"]), "k", "first", "second") == [(1, "x", "b")]


def test_d27_rollup(spark):
    from sparktrail.operators.attribution import rollup_daily
    d = spark.createDataFrame([(7, "w", 1, 1, 2, 0, 10), (7, "w", 1, 1, 3, 0, 20)],
                              "coupon_id long, web_id string, coupon_imp long, coupon_accepted long, coupon_used long, cost long, revenue long")
    r = rollup_daily(d).first()
    assert (r.coupon_used, r.revenue) == (5, 30)


def test_d28_daily_reach(spark):
    from sparktrail.operators.attribution import daily_reach
    t = dt.datetime(2024, 1, 5, 10)
    acc = spark.createDataFrame([("w", 1, "u1", t)], "web_id string, coupon_id long, uuid string, date_time timestamp_ntz")
    dis = spark.createDataFrame([("w", 1, "u1", t), ("w", 1, "u2", t)], "web_id string, coupon_id long, uuid string, date_time timestamp_ntz")
    sp = spark.createDataFrame([(1, "w", dt.date(2024, 1, 1), dt.date(2024, 1, 10), dt.date(2024, 1, 5))],
                               "id long, web_id string, activity_start date, spine_end date, d date")
    a, i = daily_reach(acc, dis, sp)
    assert a.first().coupon_accepted == 1 and i.first().coupon_imp == 2
