"""Scalar column functions: price text, coupon coercion, minimum spend,
string helpers (C10-C14, P11, P12, F13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_to_int(c, default: int = -1) -> Column:
    """Price text -> integer.

    A whole signed integer is taken as is; otherwise all runs of ``[0-9.]``
    are concatenated and parsed as a float, then truncated. Anything that
    does not parse gives ``default``, as does a number beyond 64 bits. Spaces
    around a signed number make it text, which loses the sign.
    """
    s = col_(c).cast("string")
    whole = s.rlike(r"^-?[0-9]+$")
    joined = F.concat_ws("", F.regexp_extract_all(s, F.lit(r"[0-9.]+"), 0))
    parsed = F.when(whole, s.try_cast("bigint")).otherwise(joined.try_cast("double").try_cast("bigint"))
    return F.coalesce(parsed, F.lit(default).cast("bigint"))


def coupon_number(c) -> Column:
    """C14: numeric value of a text under MySQL implicit cast: the leading
    number of the string (after spaces), else 0."""
    lead = F.regexp_extract(col_(c).cast("string"), r"^\s*([-+]?[0-9]*[.]?[0-9]+)", 1)
    return F.coalesce(F.nullif(lead, F.lit("")).try_cast("double"), F.lit(0.0))


def min_spend(coupon_limit) -> Column:
    """integer after ``limit-bill=``, else 0."""
    has = F.instr(col_(coupon_limit), "limit-bill=") > 0
    tail = F.substring_index(col_(coupon_limit), "limit-bill=", -1)
    return F.when(has, F.coalesce(tail.try_cast("int"), F.lit(0))).otherwise(F.lit(0))


def csv_split(c) -> Column:
    """C11: csv text -> array<string>."""
    return F.split(col_(c), ",")


def csv_doubles(c) -> Column:
    return F.transform(F.split(col_(c), ","), lambda x: F.trim(x).try_cast("double"))


def sigmoid(x) -> Column:
    """C13."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(x)))
