"""Property tests and plan-shape tests (SURVEY 5.4)."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from smoke import SMOKE


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=30))
def test_moving_average_window_one_is_identity(spark, values):
    from sparktrail.operators.ordered import moving_average
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, o int, v double")
    got = [r.v_mavg for r in moving_average(df, ["k"], ["o"], "v", 1).orderBy("o").collect()]
    assert got == pytest.approx(values)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=40))
def test_running_rank_matches_sort(spark, values):
    from sparktrail.operators.ordered import running_totals
    df = spark.createDataFrame([(f"k{v % 3}", i, v) for i, v in enumerate(values)], "k string, i int, v int")
    got = {(r.k, r.i): r._rank for r in running_totals(df, ["k"], [F.col("v").desc(), F.col("i")], n_partitions=3).collect()}
    exp = {}
    for key in {f"k{v % 3}" for v in values}:
        items = sorted([(v, i) for i, v in enumerate(values) if f"k{v % 3}" == key], key=lambda x: (-x[0], x[1]))
        for rnk, (_, i) in enumerate(items, 1):
            exp[(key, i)] = rnk
    assert got == exp


def test_upsert_is_idempotent(spark):
    from sparktrail.operators.upsert import upsert
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    u = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    once = upsert(t, u, ["k"])
    twice = upsert(once, u, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_banner_credit_is_a_subset_counted_once(spark):
    from sparktrail.plans.registry import QUERIES
    df = QUERIES["banner_revenue"](spark, SMOKE)
    r = df.agg(F.sum("transaction").alias("t"), F.sum("sessions").alias("s")).first()
    assert r.t <= r.s


def test_release_is_disjoint_from_accepted(spark):
    from sparktrail.plans import adapters as A
    from sparktrail.plans.registry import QUERIES
    rel = QUERIES["coupon_release"](spark, SMOKE)
    _, acc = A.batch_codes(A.base_events(spark, SMOKE))
    assert rel.join(acc, ["web_id", "link_code", "coupon_code"]).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["roas_lifetime_mixed", "roas_daily_mixed", "banner_revenue", "tracker_stats",
                                  "session_features", "bound_by_rank", "flatten_purchase"])
def test_no_cartesian_or_python_rows(spark, name):
    from sparktrail.plans.registry import QUERIES
    p = _plan(QUERIES[name](spark, SMOKE))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p


def test_scan_prunes_columns(spark):
    from sparktrail.plans.registry import QUERIES
    p = QUERIES["order_revenue"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in p.split("ReadSchema")[1].split("\n")[0]
