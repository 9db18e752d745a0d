"""Least-squares polynomials as column expressions.

The points of a fit are two arrays (bounded by the number of bins). The fit is
in the basis of polynomials that are orthogonal over these points, which a
three-term recurrence gives one degree at a time, on abscissas scaled to [-1, 1]:
no normal equations, whose moments a double can't hold at degree 10. A fit is
its scale and the recurrence's coefficients, and is evaluated by the recurrence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STATE = "struct<p:array<double>,q:array<double>,norm:double,a:array<double>,b:array<double>,c:array<double>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)


def _scaled(x: Column, lo: Column, hi: Column) -> Column:
    return F.when(hi > lo, (x - lo) * 2.0 / (hi - lo) - 1.0).otherwise(F.lit(0.0))


def fit(x: Column, y: Column, deg: int) -> Column:
    """struct(lo, hi, a, b, c): the polynomial of at most ``deg`` through arrays ``x`` and ``y``, and of no more
    coefficients than there are distinct x; null without points."""
    lo, hi = F.array_min(x), F.array_max(x)
    degree = F.least(F.lit(deg), F.size(F.array_distinct(x)) - 1)
    xs = F.transform(x, lambda v: _scaled(v, lo, hi))
    zeros, ones = F.transform(x, lambda v: v * 0.0), F.transform(x, lambda v: v * 0.0 + 1.0)
    none = F.array().cast("array<double>")
    start = F.struct(ones.alias("p"), zeros.alias("q"), F.lit(0.0).alias("norm"), none.alias("a"), none.alias("b"),
                     none.alias("c")).cast(_STATE)

    def step(points: Column):
        def at(s: Column, k: Column) -> Column:
            squares = F.transform(s["p"], lambda v: v * v)
            facts = F.struct(_dot(s["p"], s["p"]).alias("norm"), _dot(points["x"], squares).alias("xpp"),
                             _dot(points["y"], s["p"]).alias("yp"))
            return _let(facts, lambda f: _let(
                F.struct((f["xpp"] / f["norm"]).alias("a"), F.when(k > 0, f["norm"] / s["norm"]).otherwise(0.0).alias("b")),
                lambda g: F.struct(
                    F.zip_with(F.zip_with(points["x"], s["p"], lambda u, v: (u - g["a"]) * v), s["q"],
                               lambda u, v: u - g["b"] * v).alias("p"),
                    s["p"].alias("q"), f["norm"].alias("norm"), F.array_append(s["a"], g["a"]).alias("a"),
                    F.array_append(s["b"], g["b"]).alias("b"),
                    F.array_append(s["c"], f["yp"] / f["norm"]).alias("c")).cast(_STATE)))
        return at

    done = _let(F.struct(xs.alias("x"), y.alias("y")), lambda points: F.aggregate(
        F.sequence(F.lit(0), degree), start, step(points)))
    return F.when(F.size(x) > 0, _let(done, lambda d: F.struct(
        lo.alias("lo"), hi.alias("hi"), d["a"].alias("a"), d["b"].alias("b"), d["c"].alias("c"))))


def value_at(f: Column, x: Column) -> Column:
    """The value of a ``fit`` at ``x``."""
    kind = "struct<cur:double,prev:double,total:double>"
    at = _scaled(x, f["lo"], f["hi"])
    start = F.struct(F.lit(1.0).alias("cur"), F.lit(0.0).alias("prev"), F.lit(0.0).alias("total")).cast(kind)

    def step(s: Column, i: Column) -> Column:
        return F.struct(((at - f["a"][i]) * s["cur"] - f["b"][i] * s["prev"]).alias("cur"), s["cur"].alias("prev"),
                        (s["total"] + f["c"][i] * s["cur"]).alias("total")).cast(kind)

    return F.when(f.isNotNull() & x.isNotNull(), F.aggregate(F.sequence(F.lit(0), F.size(f["c"]) - 1), start, step)["total"])
