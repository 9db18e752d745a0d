"""Purchase-propensity model operators.

Scoring, labelling, precision, ranks and histograms are column expressions
and aggregations; the logistic fits of all tenants are Newton steps of one
aggregate each (``logistic``); the polynomial fits of M14/M15 are expressions
over the <= 100 bins of a tenant (``polyfit``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktrail.functions.dates import lit_date
from sparktrail.functions.scalars import csv_doubles, sigmoid
from sparktrail.operators import polyfit
from sparktrail.operators.describe import histogram
from sparktrail.operators.ordered import at_rank, rank_table, running_totals
from sparktrail.plans.sizing import maybe_broadcast


def model_params(settings: DataFrame) -> DataFrame:
    """F14 ``fetch_train_model`` / ``fetch_mining_settings`` for all tenants:
    feature names, coefficients (csv -> arrays), intercept and bound knobs."""
    return settings.select(
        "web_id", F.split(F.col("model_key"), ",").alias("_keys"), csv_doubles(F.col("model_value")).alias("_w"),
        F.col("model_intercept").cast("double").alias("_b"),
        F.col("n_day_testing").cast("double").alias("n_day"), F.col("n_weight").cast("double").alias("n_weight"),
        F.col("test_size").cast("double").alias("test_size"), F.col("lower_bound").cast("double").alias("lower_bound"))


def linear_score(feature_map: Column, keys: Column, weights: Column, intercept: Column) -> Column:
    """sum_i x[key_i] * w_i + b, with per-row keys/weights (higher-order
    functions, evaluated in codegen)."""
    pairs = F.arrays_zip(keys.alias("k"), weights.alias("w"))
    return F.aggregate(pairs, F.lit(0.0),
                       lambda acc, kw: acc + F.try_element_at(feature_map, kw["k"]) * kw["w"]) + intercept


def score(features: DataFrame, params: DataFrame, candidates: list[str]) -> DataFrame:
    """``prob = sigmoid(X.w + b)`` with each tenant's stored model
    (broadcast settings), all tenants in one pass. ``candidates`` are the
    feature columns a model may name."""
    fmap = F.create_map(*[x for c in candidates for x in (F.lit(c), F.col(c).cast("double"))])
    p = maybe_broadcast(params.select("web_id", "_keys", "_w", "_b"))
    j = features.join(p, "web_id")
    return j.withColumn("prob", sigmoid(linear_score(fmap, F.col("_keys"), F.col("_w"), F.col("_b")))) \
            .drop("_keys", "_w", "_b")


def power_transform(df: DataFrame, powers: dict[str, float]) -> DataFrame:
    """Raise each feature to its power (the reference's intent)."""
    for c, pw in powers.items():
        df = df.withColumn(c, F.pow(F.col(c).cast("double"), F.lit(float(pw))))
    return df


def label_band(df: DataFrame, lower, upper=1.0, prob: str = "prob") -> DataFrame:
    """predict = 1 when lower <= prob <= upper."""
    lo = lower if isinstance(lower, Column) else F.lit(float(lower))
    hi = upper if isinstance(upper, Column) else F.lit(float(upper))
    return df.withColumn("predict", F.col(prob).between(lo, hi).cast("int"))


def confusion(df: DataFrame, group=("web_id",)) -> DataFrame:
    """Counts per (label, prediction)."""
    return df.groupBy(*group, "is_purchased", "predict").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def precision(df: DataFrame, group=("web_id",), smoothing: float = 0.0) -> DataFrame:
    """TP / PP (null when PP = 0), or TP / (PP + smoothing)."""
    tp = F.sum(((F.col("is_purchased") == 1) & (F.col("predict") == 1)).cast("int"))
    pp = F.sum((F.col("predict") == 1).cast("int"))
    val = F.try_divide(tp.cast("double"), pp.cast("double") + F.lit(smoothing)) if smoothing \
        else F.try_divide(tp.cast("double"), F.nullif(pp, F.lit(0)).cast("double"))
    return df.groupBy(*group).agg(val.alias("precision"))


def roc_points(df: DataFrame, group=("web_id",), prob: str = "prob", label: str = "is_purchased") -> DataFrame:
    """(fpr, tpr) at each distinct score, thresholds descending.

    Scores are first reduced to distinct values with label counts; running
    sums use the skew-proof ``running_totals`` (no single-task window)."""
    g = list(group)
    d = df.groupBy(*g, F.col(prob).alias("threshold")).agg(
        F.sum(F.col(label).cast("double")).alias("pos"), F.sum(1 - F.col(label).cast("double")).alias("neg"))
    r = running_totals(d, g, [F.col("threshold").desc()], sums=["pos", "neg"], totals=True)
    return r.select(*g, "threshold", F.try_divide(F.col("_cum_neg"), F.col("_total_neg")).alias("fpr"),
                    F.try_divide(F.col("_cum_pos"), F.col("_total_pos")).alias("tpr"))


def feature_corr(df: DataFrame, features: list[str], group=("web_id",), label: str = "is_purchased") -> DataFrame:
    """Pearson correlation of each feature with the label."""
    return df.groupBy(*group).agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c)
                                    for c in features])


def mining_window(df: DataFrame, settings: DataFrame, as_of, ts: str = "date_time") -> DataFrame:
    """M01's read window, per tenant: the ``n_day_mining`` days that end ``n_day_testing`` days before as_of (both ends
    whole days). Rows of tenants without settings are no training rows."""
    days = maybe_broadcast(settings.select("web_id", F.col("n_day_testing").cast("int").alias("_test"),
                                           F.col("n_day_mining").cast("int").alias("_mine")))
    end = F.date_sub(lit_date(as_of), F.col("_test"))
    day = F.to_date(F.col(ts))
    return df.join(days, "web_id").where(day.between(F.date_sub(end, F.col("_mine")), end)).drop("_test", "_mine")


def train_test_split(df: DataFrame, test_size: float = 0.3, seed: int = 25, keys=("uuid", "session_id")) -> DataFrame:
    """Deterministic split, stable under repartitioning and task retries; adds ``is_test``. A row's lot is the
    number in the first 8 hex digits of the MD5 digest of its keys and the seed, joined by ``|`` (a null is empty), so any
    engine draws the same."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    lot = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10000
    return df.withColumn("is_test", (lot < int(round(test_size * 10000))).cast("int"))


def train_models(features_df: DataFrame, settings: DataFrame, features: list[str], C: float = 1.0) -> DataFrame:
    """M01 + M18 for every tenant of the settings that has rows, and 'default' for all of them: model record rows
    (web_id, model_value csv with 8 decimals, model_intercept) and how many rows were used, and of these had a null
    feature."""
    from sparktrail.operators.logistic import fit_tenants
    mine = features_df.join(maybe_broadcast(settings.select("web_id").distinct()), "web_id", "left_semi")
    fits = model_record(fit_tenants(mine, features, C=C))
    return fits.select("web_id", "model_value", F.col("intercept").alias("model_intercept"), "n_rows", "n_null_rows")


def model_record(coefs: DataFrame) -> DataFrame:
    """M18 as a column transform: array<double> -> csv with 8 decimals."""
    return coefs.withColumn("model_value", F.array_join(F.transform("coef", lambda c: F.format_string("%.8f", c)), ","))


def traffic_and_rank_bound(scored: DataFrame, budgets: DataFrame, params: DataFrame) -> DataFrame:
    """Per campaign: ``max_n_coupon = int(#(pageviews>1) / n_day)``;
    target = avg_n_coupon * n_weight; bound = score at position
    ``int(min-side count * n_day) - 1`` (descending, Python indexing:
    -1 -> lowest score); floor ``1.1 * sigmoid(b)`` when bound <= sigmoid(b).

    scored: (web_id, uuid, prob, pageviews, ...) one row per visitor;
    budgets: (id, web_id, avg_n_coupon)."""
    pr = params.select("web_id", "n_day", "n_weight", "_b")
    traffic = scored.groupBy("web_id").agg(F.sum((F.col("pageviews") > 1).cast("int")).alias("_pv"))
    b = (budgets.join(maybe_broadcast(pr), "web_id").join(traffic, "web_id")
         .withColumn("max_n_coupon", F.floor(F.col("_pv") / F.col("n_day")).cast("bigint"))
         .withColumn("_target", F.col("avg_n_coupon") * F.col("n_weight"))
         .withColumn("_pos", F.when(F.col("_target") >= F.col("max_n_coupon"),
                                    F.floor(F.col("max_n_coupon") * F.col("n_day")))
                             .otherwise(F.expr("cast(avg_n_coupon * n_day * n_weight as bigint)")).cast("bigint") - 1))
    from sparktrail.plans.materialize import materialize
    table = materialize(rank_table(scored, ["web_id"], "prob").withColumnRenamed("prob", "_raw"))
    n = table.groupBy("web_id").agg(F.max("total").alias("_n"))  # a row per tenant, for a row per campaign
    b = b.join(n, "web_id").withColumn("_rank", F.when(F.col("_pos") < 0, F.col("_pos") + F.col("_n"))
                                       .otherwise(F.col("_pos")) + 1)
    picked = at_rank(table, b, ["web_id"], "_raw", "_rank")
    limit = sigmoid(F.col("_b"))
    return picked.select("id", "web_id", "avg_n_coupon", "max_n_coupon",
                         F.when(F.col("_raw") <= limit, limit * 1.1).otherwise(F.col("_raw")).alias("lower_bound"),
                         "n_day")


def counts_above(scored: DataFrame, bounds: DataFrame) -> DataFrame:
    """(id, _n, _tp): visitors of the campaign's tenant with ``lower_bound <= prob <= 1``, and the purchasers of them.

    The bounds are sorted in among the distinct scores, and the running totals at a
    bound's place are its counts: as many rows as scores and campaigns, no pairs."""
    kind = bounds.schema["id"].dataType
    inside = (F.col("prob") <= 1).cast("double")
    scores = scored.where(F.col("prob").isNotNull()).groupBy("web_id", F.col("prob").alias("p")).agg(
        F.sum(inside).alias("n"), F.sum(inside * F.coalesce((F.col("is_purchased") == 1).cast("double"), F.lit(0.0))).alias("tp"))
    visitors = scores.select("web_id", "p", F.lit(None).cast("string").alias("campaign"), "n", "tp")
    marks = bounds.where(F.col("lower_bound").isNotNull()).select(
        "web_id", F.col("lower_bound").alias("p"), F.col("id").cast("string").alias("campaign"),
        F.lit(0.0).alias("n"), F.lit(0.0).alias("tp"))
    order = [F.col("p").desc(), F.col("campaign").asc_nulls_first()]
    run = running_totals(visitors.unionByName(marks), ["web_id"], order, ["n", "tp"])
    return run.where(F.col("campaign").isNotNull()).select(
        F.col("campaign").cast(kind).alias("id"), F.col("_cum_n").cast("bigint").alias("_n"),
        F.col("_cum_tp").cast("bigint").alias("_tp"))


def bound_assembly(scored: DataFrame, budgets: DataFrame, params: DataFrame, use_fit: bool = False) -> DataFrame:
    """Per campaign id, max_n_coupon, avg_n_coupon, lower_bound (by rank, M13, or
    with ``use_fit`` from the fitted curve, M14), estimated_n_coupon (M16) and
    model_precision (M05, M08). ``scored`` has one row per tenant's visitor."""
    # read by the traffic, bound and counting branches
    from sparktrail.plans.materialize import materialize
    scored = materialize(scored.select("web_id", "uuid", "prob", "pageviews", "is_purchased"))
    if use_fit:
        per_day = maybe_broadcast(params.select("web_id", "n_day"))
        lb = (fitted_curve_bound(scored, budgets, params)
              .join(budgets.select("id", "avg_n_coupon"), "id").join(per_day, "web_id"))
    else:
        lb = traffic_and_rank_bound(scored, budgets, params)
    lb = materialize(lb)  # one row per campaign
    counts = counts_above(scored.where(F.col("uuid").isNotNull()), lb.select("id", "web_id", "lower_bound"))
    n, tp = (F.coalesce(F.col(c), F.lit(0)) for c in ("_n", "_tp"))
    return lb.join(counts, "id", "left").select(
        "id", "max_n_coupon", "avg_n_coupon", "lower_bound",
        F.floor(n / F.col("n_day")).cast("bigint").alias("estimated_n_coupon"),
        (tp.cast("double") / (n.cast("double") + F.lit(0.1))).alias("model_precision"))


def _points(h: DataFrame, x: Column) -> DataFrame:
    """(web_id, x, y): a tenant's bins in order as arrays, at most as long as there are bins."""
    return (h.groupBy("web_id").agg(F.sort_array(F.collect_list(F.struct("bin", x.alias("x"), F.col("left").alias("y"))))
                                    .alias("p")).select("web_id", F.col("p.x").alias("x"), F.col("p.y").alias("y")))


def fitted_curve_bound(scored: DataFrame, budgets: DataFrame, params: DataFrame,
                       bins: int = 100, deg: int = 10, min_prob: float = 0.06) -> DataFrame:
    """100-bin histogram of scores per tenant, per-day reverse
    cumulative counts, bins with left edge > 0.06, degree-10 polynomial
    prob(cumulative), evaluated for each campaign at min(target, first
    cumulative) and not below the last; same floor as M13. One fit per tenant."""
    h = histogram(scored, "prob", bins, group=["web_id"])
    pr = params.select("web_id", "n_day", "n_weight", "_b")
    w = Window.partitionBy("web_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # of at most ``bins`` rows
    above = F.sum("count").over(Window.partitionBy("web_id")) - F.sum("count").over(w)
    h = h.withColumn("_above", above).join(maybe_broadcast(pr), "web_id").where(F.col("left") > min_prob)
    points = _points(h, F.col("_above") / F.col("n_day"))
    fits = points.select("web_id", polyfit.fit(F.col("x"), F.col("y"), deg).alias("fit"), F.col("x")[0].alias("x0"),
                         F.element_at("x", -1).alias("x1"))
    b = budgets.join(maybe_broadcast(pr), "web_id").join(fits, "web_id", "left")
    target = F.col("avg_n_coupon") * F.col("n_weight")
    raw = polyfit.value_at(F.col("fit"), F.greatest(F.least(target, F.col("x0")), F.col("x1")))
    limit = sigmoid(F.col("_b"))
    return b.select("id", "web_id", F.col("x0").alias("max_n_coupon"), raw.alias("raw"), limit.alias("limit")).select(
        "id", "web_id", "max_n_coupon", F.when(F.col("raw") <= F.col("limit"), F.col("limit") * 1.1)
        .otherwise(F.col("raw")).alias("lower_bound"))


def upper_bound_at(scored_test: DataFrame, params: DataFrame, n_coupon_per_day: float,
                   bins: int = 50, deg: int = 4) -> DataFrame:
    """Per tenant, 50-bin histogram of test scores above the tenant's
    lower bound, counts / test_size / n_day, cumulative, degree-4 fit of
    left edge on cumulative, evaluated at n_coupon_per_day * n_weight, inside
    the range of the fitted points; a bound is a probability, from 0 to 1."""
    pr = params.select("web_id", "n_day", "n_weight", "test_size", "lower_bound")
    s = scored_test.join(maybe_broadcast(pr.select("web_id", F.col("lower_bound").alias("_lb"))), "web_id") \
                   .where(F.col("prob") > F.col("_lb"))
    h = histogram(s, "prob", bins, group=["web_id"])
    w = Window.partitionBy("web_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("_upto", F.sum("count").over(w)).join(maybe_broadcast(pr), "web_id")
    points = _points(h, F.col("_upto") / F.col("test_size") / F.col("n_day"))
    fits = points.select("web_id", polyfit.fit(F.col("x"), F.col("y"), deg).alias("fit"), F.col("x")[0].alias("x0"),
                         F.element_at("x", -1).alias("x1")).join(maybe_broadcast(pr), "web_id")
    at = F.least(F.greatest(F.lit(float(n_coupon_per_day)) * F.col("n_weight"), F.col("x0")), F.col("x1"))
    return fits.select("web_id", F.least(F.greatest(polyfit.value_at(F.col("fit"), at), F.lit(0.0)), F.lit(1.0))
                       .alias("upper_bound"))


def estimate_coupons(pred: DataFrame, params: DataFrame, test_size: float | None = None) -> DataFrame:
    """``int(distinct visitors predicted 1 / n_day [/ test_size])``."""
    pr = params.select("web_id", "n_day")
    c = pred.where(F.col("predict") == 1).groupBy("web_id").agg(F.count_distinct("uuid").alias("_u"))
    den = F.col("n_day") * (F.lit(test_size) if test_size else F.lit(1.0))
    return c.join(maybe_broadcast(pr), "web_id").select("web_id", F.floor(F.col("_u") / den).cast("bigint")
                                                     .alias("estimated_n_coupon"))
