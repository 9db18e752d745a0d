"""Ranks, moving averages, fits: against plain Python, numpy and Spark ML; plans of the daily matrix."""

import random

import numpy as np
import pytest
from smoke import SMOKE


@pytest.mark.parametrize("m,n_partitions", [(1, 3), (3, 7), (50, 9), (5, 1)])
def test_moving_average(spark, m, n_partitions):
    from sparktrail.operators.ordered import moving_average
    rnd = random.Random(m)
    rows = [(k, i, rnd.choice([None, rnd.random() * 100])) for k in ("hot", "a", None, "None") for i in range(120 if k == "hot" else 9)]
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(4)
    got = moving_average(df, ["k"], ["i"], "v", m, n_partitions).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"k", "i", "v", "v_mavg"}
    of = {}
    for k, i, v in rows:
        of.setdefault(k, []).append(v)
    for r in got:
        held = [x for x in of[r.k][max(0, r.i - m + 1):r.i + 1] if x is not None]
        assert (r.v_mavg is None) == (not held) and (not held or abs(r.v_mavg - sum(held) / len(held)) < 1e-9)


def test_rank_table_and_scores_at_ranks(spark):
    from sparktrail.operators.ordered import at_rank, nth_largest, rank_table
    rnd = random.Random(5)
    rows = [(w, rnd.randrange(30) / 30) for w in ("a", "b", None) for _ in range(200)] + [("hot", 0.5)] * 1000 + [("one", 0.1)]
    df = spark.createDataFrame(rows, "w string, p double").repartition(5)
    table = rank_table(df, ["w"], "p").cache()
    ranked = {w: sorted((p for v, p in rows if v == w), reverse=True) for w in {w for w, _ in rows}}
    for r in table.collect():
        held = ranked[r.w]
        assert (r.n, r.upto, r.total) == (held.count(r.p), sum(p >= r.p for p in held), len(held))
    assert table.where("w = 'hot'").count() == 1  # equal scores are one row
    asked = [(w, k) for w in ranked for k in (0, 1, 2, 37, 200, 201, 1000, 1001)] + [("none", 1)]
    got = at_rank(table, spark.createDataFrame(asked, "w string, k long"), ["w"], "p", "k").collect()
    assert len(got) == len(asked)
    for r in got:
        held = ranked.get(r.w, [])
        assert r.p == (held[r.k - 1] if 1 <= r.k <= len(held) else None)
    plan = nth_largest(df, ["w"], "p", ["p"])
    assert {(r.w, r._n) for r in plan.collect()} == {(w, len(v)) for w, v in ranked.items()}


def test_polynomials_equal_numpy(spark):
    from pyspark.sql import functions as F

    from sparktrail.operators import polyfit
    rnd = random.Random(2)
    curves = [[(float(x), rnd.random()) for x in range(n)] for n in (1, 2, 5, 12, 100)]
    curves += [[(1e6 - 3.7 * x * x, float(np.sin(x / 9))) for x in range(60)], [(5.0, 1.0), (5.0, 3.0)], [(1.0, 2.0), (1.0, 4.0), (2.0, 5.0)]]
    df = spark.createDataFrame([(i, [x for x, _ in c], [y for _, y in c]) for i, c in enumerate(curves)] + [(99, [], [])],
                               "i int, x array<double>, y array<double>")
    for deg in (0, 3, 10):
        fits = df.select("i", "x", polyfit.fit(F.col("x"), F.col("y"), deg).alias("f"))
        got = fits.select("i", F.transform("x", lambda v: polyfit.value_at(F.col("f"), v)).alias("v")).collect()
        for r in got:
            if r.i == 99:
                assert r.v == []
                continue
            x, y = (np.array(v) for v in zip(*curves[r.i]))
            d = min(deg, len(set(x)) - 1)
            want = np.polynomial.Polynomial.fit(x, y, d)(x) if len(set(x)) > 1 else np.full(len(x), y.mean())
            assert np.allclose(r.v, want, atol=1e-7), (r.i, deg)


def test_grouped_fit_equals_spark_ml(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from sparktrail.operators.logistic import fit_tenants
    rnd = random.Random(4)
    rows = []
    for w, n in (("a", 400), ("b", 60), ("c", 8)):
        for _ in range(n):
            x = [rnd.gauss(0, 1), rnd.gauss(500, 300), float(rnd.randrange(3))]
            rows.append((w, *x, int(rnd.random() < 1 / (1 + np.exp(-(x[0] + 0.004 * x[1] - 2))))))
    rows += [("same", 1.0, 2.0, 0.0, 0)] * 5 + [("yes", 1.0, None, 0.0, 1)] * 3 + [("a", 0.0, 1.0, 1.0, None), (None, 1.0, 1.0, 1.0, 1)]
    names = ["f1", "f2", "f3"]
    df = spark.createDataFrame(rows, "web_id string, f1 double, f2 double, f3 double, is_purchased int").repartition(5)
    got = {r.web_id: r for r in fit_tenants(df, names).collect()}
    assert set(got) == {"a", "b", "c", "same", "yes", "default"}
    for w in ("a", "b", "c", "default"):
        mine = [r for r in rows if r[4] is not None and r[0] is not None and (w == "default" or r[0] == w)]
        data = spark.createDataFrame([(*(x or 0.0 for x in r[1:4]), float(r[4])) for r in mine], [*names, "y"])
        data = VectorAssembler(inputCols=names, outputCol="x").transform(data)
        want = LogisticRegression(featuresCol="x", labelCol="y", regParam=1 / len(mine), elasticNetParam=0.0, standardization=False,
                                  maxIter=1000, tol=1e-14).fit(data)
        def loss(coef, b):
            z = np.array([r[1:4] for r in mine], float)
            z = np.nan_to_num(z) @ np.array(coef) + b
            y = np.array([r[4] for r in mine], float)
            return np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.dot(coef, coef)
        assert np.allclose(got[w].coef, want.coefficients.toArray(), atol=1e-5) and abs(got[w].intercept - want.intercept) < 1e-4
        assert loss(got[w].coef, got[w].intercept) <= loss(want.coefficients.toArray(), want.intercept) + 1e-9
        assert got[w].n_rows == len(mine)
    assert got["same"].intercept == float("-inf") and got["yes"].intercept == float("inf") and got["yes"].n_null_rows == 3


def test_the_daily_matrix_reads_the_events_once(spark):
    from sparktrail.operators import attribution as ATT
    from sparktrail.plans import adapters as A
    from sparktrail.plans.context import Tables
    t = Tables(spark, SMOKE, A.MIXED_CELLS)
    first = ATT.daily_buckets(t.tagged, t.cells)._jdf.queryExecution().executedPlan().toString()
    rest = ATT.roas_daily_tagged(t.tagged, t.activities("all"), t.cells, t.addfan_stat, A.AS_OF)
    rest = rest._jdf.queryExecution().executedPlan().toString()
    scans = [p.count("events.parquet") for p in (first, rest)]
    shuffles = sum(p.count("Exchange hashpartitioning") for p in (first, rest))
    assert scans == [1, 0] and shuffles <= 20, (scans, shuffles)


def test_lots_are_the_digest_of_the_keys(spark):
    import hashlib

    from sparktrail.operators.model import train_test_split
    df = spark.createDataFrame([(f"u{i}", f"s{i % 7}") for i in range(400)] + [(None, "s")], "uuid string, session_id string")
    got = train_test_split(df, 0.3, 25).collect()
    for r in got:
        lot = int(hashlib.md5(f"{r.uuid or ''}|{r.session_id}|25".encode()).hexdigest()[:8], 16) % 10000
        assert r.is_test == int(lot < 3000)
    assert 80 < sum(r.is_test for r in got) < 160
