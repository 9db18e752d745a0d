"""Descriptive statistics.

Histograms follow numpy's equal-width binning exactly (edges
``min + i * (max - min) / n``, last bin closed, constant data widened by
0.5 on each side); per-group bounds come from one aggregation and are
broadcast back, so no data-sized window or cross product is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktrail.plans.materialize import materialize
from sparktrail.plans.sizing import maybe_broadcast


def _edges(mn: Column, mx: Column, n: int):
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    return lo, hi


def histogram(df: DataFrame, value: str, n_bins: int, group=(), density: bool = False) -> DataFrame:
    """``n_bins`` equal-width bins over [min, max] per group; every bin
    is reported (empty ones with 0): (group..., bin, left, right, count[,
    density = count / total / width])."""
    g = list(group)
    x = F.col(value).cast("double")
    st = df.where(x.isNotNull()).groupBy(*g).agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"),
                                                  F.count(F.lit(1)).alias("_tot"))
    lo, hi = _edges(F.col("_mn"), F.col("_mx"), n_bins)
    st = materialize(st.select(*g, lo.alias("_lo"), hi.alias("_hi"), "_tot",
                               ((hi - lo) / F.lit(float(n_bins))).alias("_step")))
    j = df.where(x.isNotNull()).select(*g, x.alias("_x"))
    if g:
        j = j.join(maybe_broadcast(st), g)
    else:
        j = j.withColumn("_k", F.lit(1)).join(F.broadcast(st.withColumn("_k", F.lit(1))), "_k").drop("_k")

    def edge(i):
        return F.when(i >= n_bins, F.col("_hi")).otherwise(i.cast("double") * F.col("_step") + F.col("_lo"))
    f = ((F.col("_x") - F.col("_lo")) * (F.lit(float(n_bins)) / (F.col("_hi") - F.col("_lo")))).cast("long")
    f = F.when(f == n_bins, F.lit(n_bins - 1)).otherwise(f)
    f = F.when(F.col("_x") < edge(f), f - 1) \
         .when((F.col("_x") >= edge(f + 1)) & (f != n_bins - 1), f + 1).otherwise(f)
    cnt = j.groupBy(*g, f.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = st.select(*g, "_lo", "_hi", "_step", "_tot",
                      F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bins - 1).cast("long"))).alias("bin"))
    out = spine.join(cnt, [*g, "bin"], "left").select(
        *g, "bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"), "_tot", "_step")
    if density:
        out = out.withColumn("density", F.col("count") / F.col("_tot") / F.col("_step"))
    return out.drop("_tot", "_step")


def fixed_width_histogram(df: DataFrame, value: str, width: float, start: float, end: float,
                          group=(), density: bool = True) -> DataFrame:
    """M11/M12 second form: bins ``start, start+width, ...`` below
    ``end + 1`` (numpy ``arange``), last bin closed; density over the values
    inside the edges."""
    g = list(group)
    n_edges = int(math.ceil((end + 1 - start) / width))
    n_bins = n_edges - 1
    last = start + (n_edges - 1) * width
    x = F.col(value).cast("double")
    inside = df.where(x.isNotNull() & (x >= start) & (x <= last))
    b = F.least(F.floor((x - F.lit(start)) / F.lit(width)), F.lit(n_bins - 1)).cast("long")
    cnt = inside.groupBy(*g, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    tot = inside.groupBy(*g).agg(F.count(F.lit(1)).alias("_tot"))
    spine = tot.select(*g, "_tot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bins - 1).cast("long"))).alias("bin"))
    out = spine.join(cnt, [*g, "bin"], "left").select(
        *g, "bin", (F.lit(start) + F.col("bin") * width + width / 2).alias("center"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"), "_tot")
    if density:
        out = out.withColumn("density", F.col("count") / F.col("_tot") / F.lit(width))
    return out.drop("_tot")


def class_histogram(df: DataFrame, feature: str, width: float = 1, start: float = 0, end: float = 50,
                    label: str = "is_purchased", group=()) -> DataFrame:
    """Density histogram of a feature for purchasers and non-purchasers."""
    return fixed_width_histogram(df, feature, width, start, end, group=[*group, label])


def cumulative_counts(hist: DataFrame, group=(), reverse: bool = False) -> DataFrame:
    """Running count over bins (or total minus it). The input has at
    most n_bins rows per group, so a window per group is bounded."""
    g = list(group)
    w = Window.partitionBy(*g).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    c = F.sum("count").over(w)
    if reverse:
        c = F.sum("count").over(Window.partitionBy(*g)) - c
    return hist.withColumn("cum", c.cast("bigint"))


def zscore(df: DataFrame, cols: list[str], group=()) -> DataFrame:
    """(x - mean) / sample std per column (ddof = 1); NaN/undefined -> 0.
    Statistics come from one aggregation joined back on the group key."""
    g = list(group)
    st = df.groupBy(*g).agg(*[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in cols],
                            *[F.stddev_samp(F.col(c).cast("double")).alias(f"_s_{c}") for c in cols])
    if g:
        j = df.join(maybe_broadcast(materialize(st)), g)
    else:
        j = df.withColumn("_k", F.lit(1)).join(F.broadcast(st.withColumn("_k", F.lit(1))), "_k").drop("_k")
    for c in cols:
        z = F.try_divide(F.col(c).cast("double") - F.col(f"_m_{c}"), F.col(f"_s_{c}"))
        j = j.withColumn(c, F.when(F.isnan(z) | z.isNull(), F.lit(0.0)).otherwise(z))
    return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def linear_fit(df: DataFrame, x: str, y: str, group=()) -> DataFrame:
    """Least-squares line y = slope * x + intercept."""
    return df.groupBy(*group).agg(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
                                  F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"))


# Component families of the mixture densities.
def gauss(x: Column, xm: float, s: float) -> Column:
    return F.lit(1.0 / s / math.sqrt(2 * math.pi)) * F.exp(-F.pow(x - F.lit(xm), 2) / F.lit(2 * s * s))


def ln_gauss(x: Column, xm: float, s: float) -> Column:
    return F.lit(-math.log(s) - 0.5 * math.log(2 * math.pi)) - F.pow(x - F.lit(xm), 2) / F.lit(2 * s * s)


def exp_pdf(t: Column, tau: float) -> Column:
    return F.lit(1.0 / tau) * F.exp(-t / F.lit(tau))


def ln_exp_pdf(t: Column, tau: float) -> Column:
    return F.lit(-math.log(tau)) - t / F.lit(tau)


def exp_survival(t: Column, tau: float) -> Column:
    return F.exp(-t / F.lit(tau))


def mixture_density(df: DataFrame, x: str, components: list[tuple], kind: str = "gauss") -> DataFrame:
    """Weighted component densities of every row: one output row per
    (row, component) with ``density = f * pdf(x)``. Components are a short
    parameter list compiled into the expression - no join at all.

    kind: 'gauss' (f, xm, s) | 'ln_gauss' | 'exp' (f, tau) | 'ln_exp' |
    'exp_survival' | 'gauss_exp' (f, xm, s, tau: joint density of an
    independent Gaussian x and exponential t = second column)."""
    xc = F.col(x).cast("double")
    exprs = []
    for i, comp in enumerate(components):
        f = float(comp[0])
        if kind == "gauss":
            d = F.lit(f) * gauss(xc, comp[1], comp[2])
        elif kind == "ln_gauss":
            d = F.lit(math.log(f)) + ln_gauss(xc, comp[1], comp[2])
        elif kind == "exp":
            d = F.lit(f) * exp_pdf(xc, comp[1])
        elif kind == "ln_exp":
            d = F.lit(math.log(f)) + ln_exp_pdf(xc, comp[1])
        elif kind == "exp_survival":
            d = F.lit(f) * exp_survival(xc, comp[1])
        else:
            raise ValueError(kind)
        exprs.append(F.struct(F.lit(i).alias("component"), d.alias("density")))
    return df.select("*", F.inline(F.array(*exprs)))


def joint_gauss_exp(df: DataFrame, x: str, t: str, components: list[tuple]) -> DataFrame:
    """M20 joint form: f * gauss(x; xm, s) * exp(t; tau) per component."""
    xc, tc = F.col(x).cast("double"), F.col(t).cast("double")
    exprs = [F.struct(F.lit(i).alias("component"),
                      (F.lit(float(f)) * gauss(xc, xm, s) * exp_pdf(tc, tau)).alias("density"))
             for i, (f, xm, s, tau) in enumerate(components)]
    return df.select("*", F.inline(F.array(*exprs)))
