"""Registered queries against their DuckDB oracles on the smoke tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from smoke import SMOKE  # noqa: E402

SAMPLE = ["roas_lifetime_mixed", "roas_daily_tt0_cc3", "roas_lifetime_tt1_cc4", "coupon_reach", "campaign_assembly",
          "banner_revenue", "site_daily_totals", "order_revenue", "tracker_stats", "event_stats", "ad_growth",
          "coupon_release", "session_features", "score_visitors", "bound_by_rank", "roc_points", "histogram",
          "moving_avg", "block_avg", "flatten_load", "flatten_purchase", "flatten_clicks", "upsert_stats",
          "stale_coupons", "price_clean", "roas_daily_dated", "roas_daily_today", "campaigns_by_id",
          "banner_revenue_hourly", "banner_revenue_click_before", "revenue_per_session", "mining_window", "delete_rows",
          "upsert_last_order", "date_helpers", "events_by_period", "raw_retained", "tenant_rows"]


@pytest.fixture(scope="module")
def con():
    import duckdb
    from check_oracle import TABLES
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_a_callable_and_most_an_oracle():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 0.8 * len(q)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    from check_oracle import digest
    df = E.queries()[name](spark, SMOKE)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "revenue" in df.columns
