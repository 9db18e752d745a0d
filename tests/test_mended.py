"""Cases that used to drop, distort or double rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F


def test_price_keeps_within_64_bits_and_reads_padded_text(spark):
    from sparktrail.functions.scalars import price_to_int
    df = spark.createDataFrame([("NT$99999999999999999999",), (" -5 ",), ("-5",), ("1.9",), (None,)], "p string")
    assert [r[0] for r in df.select(price_to_int("p")).collect()] == [-1, 5, -5, 1, -1]


def test_delete_keeps_rows_with_a_null_condition(spark):
    from sparktrail.operators.upsert import delete_rows
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, x int")
    assert sorted(r.id for r in delete_rows(df, F.col("x") > 6).collect()) == [1, 2]


def test_upsert_leaves_one_row_for_a_key(spark):
    from sparktrail.operators.upsert import upsert
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, v string, at int")
    new = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (3, "p", 1), (3, "q", 5)], "id int, v string, at int")
    got = sorted(tuple(r) for r in upsert(old, new, ["id"], order=["at"]).collect())
    assert got == [(1, "x", 2), (2, "b", 0), (3, "q", 5)]


def test_windows_keep_null_keys_apart_from_text(spark):
    from sparktrail.operators.ordered import moving_average, running_totals
    df = spark.createDataFrame([(k, i, float(i)) for k in (None, "None", "a") for i in range(1, 5)],
                               "k string, i int, v double")
    got = sorted((str(type(r.k)), r.k or "", r.i, r._rank, r._cum_v) for r in
                 running_totals(df, ["k"], ["i"], ["v"], n_partitions=3).collect())
    assert len(got) == 12 and all(r[3] == r[2] and r[4] == r[2] * (r[2] + 1) / 2 for r in got)
    avg = {(r.k, r.i): r.v_mavg for r in moving_average(df, ["k"], ["i"], "v", 2).collect()}
    assert len(avg) == 12 and avg[None, 3] == 2.5 and avg["None", 1] == 1.0


def test_features_keep_tenants_apart(spark):
    from sparktrail.operators.features import session_features, visitor_max
    u = "0" * 36
    load = spark.createDataFrame([("wA", u, "s", 1, 1, 1, 0), ("wB", u, "s", 2, 2, 1, 0)],
                                 "web_id string, uuid string, session_id string, timestamp long, ord long, device int, "
                                 "is_purchased_before int")
    buy = load.where("web_id = 'wB'")
    none = load.limit(0)
    got = session_features(load, buy, none, none, ["web_id", "device", "is_purchased_before"])
    assert {(r.web_id, r.is_purchased) for r in got.collect()} == {("wA", 0), ("wB", 1)}
    assert visitor_max(got).count() == 2


def _product(spark, payload, keys, renames):
    from sparktrail.operators.products import product_rows
    from sparktrail.schemas import PAYLOAD_KEY
    import json
    doc = {"web_id": "w", "event_type": "addCart", "timestamp": 1, PAYLOAD_KEY["addCart"]: json.dumps(payload)}
    raw = spark.createDataFrame([(json.dumps(doc), 1)], "t string, ord long").select(
        F.parse_json("t").alias("ev"), "ord")
    settings = spark.createDataFrame([("w", "addCart", keys, renames)],
                                     "web_id string, event_type string, keys string, renames string")
    return product_rows(raw, "addCart", settings, ["ord"]).collect()


def test_product_paths_of_any_depth(spark):
    rows = _product(spark, {"a": {"b": {"c": {"d": {"e": "LEAF"}}}}, "p": "1"}, "a.b.c.d.e,p", "product_id,product_price")
    assert [r.product_id for r in rows] == ["LEAF"]


def test_product_lists_of_unequal_length_and_empty_payload(spark):
    rows = _product(spark, {"i": [{"id": "x", "p": "1"}, {"id": "y"}], "q": ["5"]}, "i.id,q", "product_id,product_price")
    assert [r.product_id for r in rows] == ["x"]
    assert _product(spark, {}, "a.b,p", "product_id,product_price") == []


def test_product_wrapper_is_the_first_key_of_the_document(spark):
    rows = _product(spark, {"z": {"a": {"id": "right"}}, "b": {"a": {"id": "wrong"}}}, "a.id", "product_id")
    assert [r.product_id for r in rows] == ["right"]


def test_retention_deletes_old_days(spark, tmp_path):
    from sparktrail.sources.raw import drop_expired
    root = str(tmp_path / "raw")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    spark.createDataFrame([(d, 0, "{}") for d in days], "dt date, hour int, ev_json string") \
        .write.partitionBy("dt", "hour").parquet(root)
    assert drop_expired(spark, root, "2024-02-01", 30) == 1
    assert {r.dt for r in spark.read.parquet(root).collect()} == set(days[1:])


def test_replayed_batch_doubles_nothing_and_corrupt_objects_land(spark, tmp_path):
    from sparktrail.plans import adapters as A
    from sparktrail.plans import raw_adapter as RA
    from sparktrail.streaming.ingest import process_batch
    from smoke import SMOKE
    objects = RA.raw_objects(A.base_events(spark, SMOKE)).select("path", "text")
    bad = spark.createDataFrame([("broken", "{no json")], "path string, text string")
    root, stats = str(tmp_path / "clean"), str(tmp_path / "stats")
    types = ["load", "leave", "timeout", "clicks"]
    for _ in range(2):
        process_batch(objects.union(bad), 7, root, types)
    once = spark.read.parquet(f"{root}/load")
    assert once.count() == once.select("ord").distinct().count() > 0
    assert [r.path for r in spark.read.parquet(f"{root}/corrupt_objects").collect()] == ["broken"]
    assert spark.read.parquet(f"{root}/clicks").count() > 0
    with pytest.raises(ValueError):
        process_batch(objects, 8, root, ["purchase"])
    assert stats


def test_unknown_event_type_is_an_error(spark):
    from sparktrail.operators.flatten import flatten
    raw = spark.createDataFrame([("{}",)], "t string").select(F.parse_json("t").alias("ev"))
    with pytest.raises(ValueError):
        flatten(raw, "nonsense")


def test_upper_bound_of_thin_data_is_a_probability(spark):
    from sparktrail.operators.model import upper_bound_at
    scored = spark.createDataFrame([("w", f"u{i}", p) for i, p in enumerate((0.3, 0.31, 0.7))], "web_id string, uuid string, prob double")
    params = spark.createDataFrame([("w", 7, 1.0, 0.3, 0.1)], "web_id string, n_day int, n_weight double, test_size double, lower_bound double")
    for n in (0.1, 5.0, 1e6):
        assert all(0 <= r.upper_bound <= 1 for r in upper_bound_at(scored, params, n).collect())


def test_counts_above_a_bound_equal_brute_force(spark):
    from sparktrail.operators.model import counts_above
    import random
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", "c"]), rnd.randrange(20) / 20, rnd.randrange(2)) for _ in range(300)]
    rows += [("a", None, 1), ("b", 0.5, None)]
    bounds = [(1, "a", 0.5), (2, "a", 0.5), (3, "b", 0.0), (4, "b", 0.99), (5, "c", 0.501), (6, "c", None), (7, "none", 0.1)]
    got = counts_above(spark.createDataFrame(rows, "web_id string, prob double, is_purchased int").repartition(5),
                       spark.createDataFrame(bounds, "id long, web_id string, lower_bound double"))
    want = {}
    for i, w, low in bounds:
        if low is not None:
            hit = [y for v, p, y in rows if v == w and p is not None and p >= low]
            want[i] = (len(hit), sum(y == 1 for y in hit))
    assert {r.id: (r._n, r._tp) for r in got.collect()} == want


def test_bound_from_the_fitted_curve_counts_its_visitors(spark):
    from sparktrail.operators.model import bound_assembly
    scored = spark.createDataFrame([("w", f"u{i}", (i % 97) / 100, 2, i % 2) for i in range(400)],
                                   "web_id string, uuid string, prob double, pageviews int, is_purchased int")
    params = spark.createDataFrame([("w", 7.0, 1.0, -3.0)], "web_id string, n_day double, n_weight double, _b double")
    budgets = spark.createDataFrame([(1, "w", 3.0), (2, "w", 20.0)], "id long, web_id string, avg_n_coupon double")
    rows = scored.collect()
    for r in bound_assembly(scored, budgets, params, use_fit=True).collect():
        hit = [x for x in rows if r.lower_bound <= x.prob <= 1]
        assert 0 < r.lower_bound < 1 and r.estimated_n_coupon == len(hit) // 7
        assert abs(r.model_precision - sum(x.is_purchased for x in hit) / (len(hit) + 0.1)) < 1e-9


def test_unknown_windowing_is_an_error():
    from sparktrail.operators.attribution import _undated
    with pytest.raises(ValueError):
        _undated("other")


def test_order_revenue_reads_the_lines_twice(spark):
    from sparktrail.operators.orders import order_revenue
    from sparktrail.plans.registry import lineitem_lines
    from smoke import SMOKE
    plan = order_revenue(lineitem_lines(spark, SMOKE))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
