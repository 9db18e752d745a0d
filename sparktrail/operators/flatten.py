"""Event flattening: raw ``ev VARIANT`` rows -> typed clean tables
(P01-P14, F03-F07).

Missing key vs JSON null: ``try_variant_get(v, path, 'variant')`` is SQL
NULL only for a missing key, so a missing key takes the sentinel ('_' for
universal keys, '-1' otherwise) while a JSON null stays NULL and the row is
dropped by the null-row rule (F05), as in the reference.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrail import schemas as S
from sparktrail.functions.dates import ms_to_local
from sparktrail.functions.scalars import price_to_int

_SIMPLE = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def vpath(key: str) -> str:
    return f"$.{key}" if _SIMPLE.match(key) else "$['" + key.replace("'", "\\'") + "']"


def present(v: Column, key: str) -> Column:
    return F.try_variant_get(v, vpath(key), "variant").isNotNull()


def field(v: Column, key: str, default: str | None) -> Column:
    """Value of ``key`` as text; ``default`` when the key is missing (or the
    whole object is missing); SQL NULL for a JSON null."""
    val = F.try_variant_get(v, vpath(key), "string")
    if default is None:
        return val
    return F.when(v.isNull() | ~present(v, key), F.lit(default)).otherwise(val)


def universal(ev: Column) -> list[Column]:
    """P01."""
    return [field(ev, k, "_").alias(c) for k, c in S.UNIVERSAL_KEYS]


def as_object(v: Column) -> Column:
    """An object given either as JSON or as a JSON string -> VARIANT."""
    return F.try_parse_json(F.try_variant_get(v, "$", "string"))


def record_user(ev: Column, event_type: str | None = None) -> list[Column]:
    """Record columns, -1 for a missing key or a missing record object."""
    rec = as_object(F.try_variant_get(ev, "$.record_user", "variant"))
    keys = S.RECORD_KEYS + (S.RECORD_PURCHASE_EXTRA if event_type == "purchase" else [])
    return [field(rec, k, "-1").alias(c) for k, c in keys]


def _payload_cols(ev: Column, payload: str, keys) -> list[Column]:
    obj = F.try_variant_get(ev, vpath(payload), "variant")
    return [field(obj, k, "-1").alias(c) for k, c in keys]


# Map form: each JSON object is converted once per row to map<string,string>
# (a missing key is absent from the map, a JSON null is a NULL value), and
# every column is a map lookup - far smaller generated code than one
# variant path lookup per column.
def as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,string>")


def mfield(m: Column, key: str, default: str) -> Column:
    return F.when(m.isNull() | ~F.map_contains_key(m, F.lit(key)), F.lit(default)) \
            .otherwise(F.try_element_at(m, F.lit(key)))


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, whatever refers to them later. The optimizer writes a column of
    ``select`` out in each later filter, inside a lambda for each of its elements; it doesn't do so with what a
    generator yields (of an inner one it infers filters that compute it too)."""
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in cols.items()]))))


def record_map(ev: Column) -> Column:
    return as_map(F.try_parse_json(F.try_variant_get(ev, "$.record_user", "string")))


def _with_maps(base: DataFrame, keep, payload: str | None) -> DataFrame:
    ev = F.col("ev")
    maps = {"_top": as_map(ev), "_rec": record_map(ev)}
    if payload:
        maps["_obj"] = as_map(F.try_variant_get(ev, vpath(payload), "variant"))
    return once(base.select(*keep, "ev"), **maps)


def _m_nulls(m: Column, keys) -> Column:
    """True when any of ``keys`` is present in map ``m`` with a JSON null -
    the F05 test for map-extracted columns, one reference to the map."""
    nulls = F.map_keys(F.map_filter(m, lambda _, value: value.isNull()))
    return F.coalesce(F.arrays_overlap(nulls, F.array(*[F.lit(k) for k, _ in keys])), F.lit(False))


def _m_universal() -> list[Column]:
    return [mfield(F.col("_top"), k, "_").alias(c) for k, c in S.UNIVERSAL_KEYS]


def _m_record(event_type: str | None = None) -> list[Column]:
    keys = S.RECORD_KEYS + (S.RECORD_PURCHASE_EXTRA if event_type == "purchase" else [])
    return [mfield(F.col("_rec"), k, "-1").alias(c) for k, c in keys]


def _m_payload(keys) -> list[Column]:
    return [mfield(F.col("_obj"), k, "-1").alias(c) for k, c in keys]


def array_csv(c: Column, fallback: str | None) -> Column:
    """JSON list -> comma-joined text; non-list -> its text (or
    ``fallback``)."""
    arr = F.try_variant_get(F.try_parse_json(c), "$", "array<string>")
    return F.coalesce(F.array_join(arr, ","), c if fallback is None else F.lit(fallback))


def length_guard(df: DataFrame, limits: dict | None = None) -> DataFrame:
    """text length <= limit for the columns present."""
    for c, n in (limits or S.LENGTH_LIMITS).items():
        if c in df.columns:
            df = df.where(F.length(F.col(c).cast("string")) <= n)
    return df


def drop_null_rows(df: DataFrame, cols=None) -> DataFrame:
    """drop rows with a null in any declared column."""
    # One opaque predicate instead of na.drop's IsNotNull conjunction: with
    # dozens of aliases of one variant column, per-column IsNotNull
    # constraints make Catalyst's constraint propagation explode.
    cols = list(cols or df.columns)
    if not cols:
        return df
    vals = F.array(*[F.col(f"`{c}`").isNull() for c in cols])
    return df.where(~F.array_contains(vals, True))


def _finish(df: DataFrame, event_type: str) -> DataFrame:
    """P13 date_time, per-type fixes, F05, F03."""
    df = df.withColumn("date_time", ms_to_local(F.col("timestamp").try_cast("bigint"), 8))
    if event_type == "purchase":
        df = df.drop(*[c for c in S.PURCHASE_DROP if c in df.columns])
        for c in ("product_price", "total_price", "shipping_price"):
            if c in df.columns:
                df = df.withColumn(c, price_to_int(F.col(c), -1))
    elif event_type in ("addCart", "removeCart", "leave", "timeout", "acceptCoupon", "discardCoupon",
                        "sendAfAd", "acceptAf", "acceptAd"):
        for c in ("max_time_no_scroll_array", "max_time_no_scroll_depth_array"):
            if c in df.columns:
                df = df.withColumn(c, array_csv(F.col(c), None))
    elif event_type == "sendCoupon":
        df = df.drop(*[c for c in S.SEND_COUPON_DROP if c in df.columns])
        for c in ("model_keys", "model_parameters", "model_X"):
            df = df.withColumn(c, array_csv(F.col(c), "_"))
    elif event_type == "enterCoupon":
        df = df.where(F.col("coupon_code") != "")
    if "_bad" in df.columns:
        # map-extracted columns: null test computed once per map
        df = df.where(~F.col("_bad") & F.col("date_time").isNotNull()).drop("_bad")
    else:
        optional = set(S.PURCHASE_PRODUCT_COLUMNS) | set(S.PRODUCT_COLUMNS) \
            if event_type in ("addCart", "removeCart", "purchase") else set()
        df = drop_null_rows(df, [c for c in df.columns if c != "ord" and c not in optional])
    return length_guard(df)


def flatten(raw: DataFrame, event_type: str, product_settings: DataFrame | None = None,
            keep=("ord",)) -> DataFrame:
    """P10 dispatcher: raw events (``ev`` VARIANT + ``keep`` columns) -> the
    clean table of ``event_type`` (``clicks``: of all click events). An unknown
    type is an error."""
    if event_type == "clicks":
        return flatten_clicks(raw, keep)
    ev = F.col("ev")
    base = raw.where(present(ev, "web_id") & present(ev, "event_type")
                     & (F.try_variant_get(ev, "$.event_type", "string") == event_type))
    keep = [c for c in keep if c in raw.columns]
    if event_type == "load":
        m = _with_maps(base.where(present(ev, "load")), keep, "load")
        bad = _m_nulls(F.col("_top"), S.UNIVERSAL_KEYS) | _m_nulls(F.col("_obj"), S.LOAD_KEYS)
        df = m.select(*keep, *_m_universal(), *_m_payload(S.LOAD_KEYS), bad.alias("_bad"))
    elif event_type in ("leave", "timeout"):
        m = _with_maps(base, keep, None)
        bad = _m_nulls(F.col("_top"), S.UNIVERSAL_KEYS) | _m_nulls(F.col("_rec"), S.RECORD_KEYS)
        df = m.select(*keep, *_m_universal(), *_m_record(), bad.alias("_bad"))
    elif event_type in ("sendCoupon", "acceptCoupon", "discardCoupon", "enterCoupon"):
        keys = {"sendCoupon": S.SEND_COUPON_KEYS, "enterCoupon": S.ENTER_COUPON_KEYS}.get(
            event_type, S.ACCEPT_COUPON_KEYS)
        rec = [] if event_type == "enterCoupon" else _m_record()
        m = _with_maps(base.where(present(ev, "coupon_info")), keep, "coupon_info")
        bad = _m_nulls(F.col("_top"), S.UNIVERSAL_KEYS) | _m_nulls(F.col("_obj"), keys)
        if rec:
            bad = bad | _m_nulls(F.col("_rec"), S.RECORD_KEYS)
        df = _dedupe_columns(m.select(*keep, *_m_universal(), *_m_payload(keys), *rec, bad.alias("_bad")))
    elif event_type in ("sendAfAd", "acceptAf", "acceptAd"):
        m = _with_maps(base.where(present(ev, "afad_info")), keep, "afad_info")
        bad = (_m_nulls(F.col("_top"), S.UNIVERSAL_KEYS) | _m_nulls(F.col("_obj"), S.AFAD_KEYS)
               | _m_nulls(F.col("_rec"), S.RECORD_KEYS))
        df = _dedupe_columns(m.select(*keep, *_m_universal(), *_m_payload(S.AFAD_KEYS), *_m_record(),
                                      bad.alias("_bad")))
    elif event_type in ("addCart", "removeCart", "purchase"):
        from sparktrail.operators.products import product_rows
        if product_settings is None:
            raise ValueError("product events need the tenant path settings")
        df = product_rows(base, event_type, product_settings, keep)
    else:
        raise ValueError(f"unknown event type {event_type!r}")
    return _finish(df, event_type)


def _dedupe_columns(df: DataFrame) -> DataFrame:
    """Later columns of the same name overwrite earlier ones (the
    reference's dict.update order)."""
    names = list(dict.fromkeys(df.columns))
    idx = {c: max(i for i, x in enumerate(df.columns) if x == c) for c in names}
    tmp = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return tmp.select(*[F.col(f"_c{idx[c]}").alias(c) for c in names])


def flatten_clicks(raw: DataFrame, keep=("ord",)) -> DataFrame:
    """Click events: needs ``click_info`` and an event name in the
    base map; ``recommend_type = base + click_info.type`` (default 0);
    missing values default to '_' / -1; no null-row drop."""
    ev = F.col("ev")
    names = list(S.CLICK_TYPE_BASE)
    et = F.try_variant_get(ev, "$.event_type", "string")
    base_map = F.create_map(*[x for k, v in S.CLICK_TYPE_BASE.items() for x in (F.lit(k), F.lit(v))])
    ci = F.try_variant_get(ev, "$.click_info", "variant")
    df = raw.where(present(ev, "click_info") & et.isin(names))
    cols = [field(ev, k, "_").alias(k) for k in S.CLICK_GENERAL]
    for k, c, d in S.CLICK_KEYS:
        if k == "type":
            t = F.coalesce(F.when(present(ci, "type"), F.try_variant_get(ci, "$.type", "int")), F.lit(0))
            cols.append((F.element_at(base_map, et) + t).alias(c))
        else:
            cols.append(field(ci, k, d).alias(c))
    keep = [c for c in keep if c in raw.columns]
    out = df.select(*keep, F.col("ev"), *cols)
    return out.withColumn("date_time", ms_to_local(F.col("timestamp").try_cast("bigint"), 8)).drop("ev")


def dedup_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """P14 (opt-in): keep the last row per key by ``order``, as one
    partial-aggregated ``max_by`` (no window)."""
    cols = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r"))
              .select(*keys, "_r.*"))
