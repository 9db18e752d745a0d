"""Day-bucket window test equals an inclusive BETWEEN on midnight bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("ts,lo,hi,expected", [
    (dt.datetime(2024, 1, 5, 0, 0, 0), dt.date(2024, 1, 5), dt.date(2024, 1, 6), True),    # at lo
    (dt.datetime(2024, 1, 6, 0, 0, 0), dt.date(2024, 1, 5), dt.date(2024, 1, 6), True),    # exactly hi
    (dt.datetime(2024, 1, 6, 0, 0, 1), dt.date(2024, 1, 5), dt.date(2024, 1, 6), False),   # after hi
    (dt.datetime(2024, 1, 4, 23, 59), dt.date(2024, 1, 5), dt.date(2024, 1, 6), False),    # before lo
    (dt.datetime(2030, 1, 1, 12, 0), dt.date(2024, 1, 5), None, True),                     # open hi
])
def test_in_window_matches_between(spark, ts, lo, hi, expected):
    from sparktrail.functions.dates import day_bucket, in_window
    df = spark.createDataFrame([(ts, lo, hi)], "ts timestamp_ntz, lo date, hi date")
    day, mid = day_bucket(F.col("ts"))
    assert df.select(in_window(day, mid, F.col("lo"), F.col("hi")).alias("w")).first().w is expected


def test_table_scan_adds_no_exchange(spark):
    from smoke import SMOKE
    from sparktrail.plans.adapters import read_table
    plan = read_table(spark, SMOKE, "events")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
