"""Tenant-configured product flatten (P07) and product-row assembly.

Each tenant configures, per product event, dotted paths into the payload
and their column names. The paths are a small broadcast dimension joined
onto the events; each path is folded over the payload segment by segment
(``aggregate`` over its segments), whatever its depth, so no shuffle and no
Python are involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrail import schemas as S
from sparktrail.plans.sizing import maybe_broadcast
from sparktrail.operators.flatten import _dedupe_columns, _m_nulls, _m_record, _m_universal, as_map, once, record_map


def product_path_settings(settings: DataFrame) -> DataFrame:
    """F14 ``fetch_parse_key_all_settings``: (web_id, event_type, keys csv,
    renames csv) for purchase / addCart / removeCart of enabled tenants."""
    parts = []
    for et in ("purchase", "addCart", "removeCart"):
        parts.append(settings.where(F.col("enable_analysis") == 1).select(
            "web_id", F.lit(et).alias("event_type"),
            F.col(f"parsed_{et}_key").alias("keys"), F.col(f"parsed_{et}_key_rename").alias("renames")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _vget(v: Column, seg: Column) -> Column:
    # not by a path: one that isn't a literal is parsed for each row
    return F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), seg)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it refers to it."""
    return F.transform(F.array(value), body)[0]


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _falsy(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v) | F.to_json(v).isin("false", "0", "0.0", '""', "[]", "{}")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _init(payload: Column):
    def f(p):
        segs = p["segs"]
        s0 = F.element_at(segs, 1)
        flat = F.size(segs) == 1

        def begun(v: Column, t: Column, dead0: Column) -> Column:
            flat_scalar = v.isNull() | F.is_variant_null(v) | (t == "STRING") | t.isin("BIGINT", "INT", "SMALLINT", "TINYINT")
            flat_list = t.startswith("ARRAY")
            items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda e: _text(e))
            return F.struct(
                segs.alias("segs"), p["rename"].alias("rename"),
                F.when(flat | dead0, F.lit(None).cast("variant")).otherwise(v).alias("cur"),
                (flat | dead0).alias("dead"),
                F.when(flat & flat_scalar, F.when(v.isNull() | F.is_variant_null(v), F.lit("-1")).otherwise(_text(v)))
                 .alias("scalar"),
                F.when(flat & flat_list, items).alias("items"))
        return _let(_vget(payload, s0), lambda v: _let(_kind(v), lambda t: _let(
            (s0 == "empty") | _falsy(v), lambda dead0: begun(v, t, dead0))))
    return f


def _step(st: Column, seg: Column) -> Column:
    cur = st["cur"]
    active = ~st["dead"] & st["items"].isNull()
    is_json = seg == "json"

    def stepped(t: Column, nv: Column, obj_dead: Column) -> Column:
        is_obj = t.startswith("OBJECT")
        is_arr = t.startswith("ARRAY")
        lst = F.transform(F.try_variant_get(cur, "$", "array<variant>"), lambda e: _let(
            _vget(e, seg), lambda v: F.when(_falsy(v), F.lit("_")).otherwise(_text(v))))
        parsed = F.try_parse_json(_text(cur))
        obj_step = active & ~is_json & is_obj
        arr_step = active & ~is_json & ~is_obj & is_arr
        other = active & ~is_json & ~is_obj & ~is_arr
        return F.struct(
            st["segs"].alias("segs"), st["rename"].alias("rename"),
            F.when(active & is_json, parsed).when(obj_step & ~obj_dead, nv)
             .when(obj_step & obj_dead, F.lit(None).cast("variant")).otherwise(cur).alias("cur"),
            (st["dead"] | (obj_step & obj_dead) | other).alias("dead"),
            F.when(obj_step, F.when(obj_dead, F.lit("_")).otherwise(_text(nv))).otherwise(st["scalar"]).alias("scalar"),
            F.when(arr_step, lst).otherwise(st["items"]).alias("items"))
    return _let(_kind(cur), lambda t: _let(_vget(cur, seg), lambda nv: _let(
        (seg == "empty") | _falsy(nv), lambda obj_dead: stepped(t, nv, obj_dead))))


def product_rows(base: DataFrame, event_type: str, settings: DataFrame, keep) -> DataFrame:
    """P07 + P08 for one product event type.

    ``settings``: ``product_path_settings`` rows (web_id, event_type, keys,
    renames). Events of unconfigured tenants, without payload, or whose
    payload is not an object are skipped.
    """
    ev = F.col("ev")
    cfg = (settings.where(F.col("event_type") == event_type)
           .select("web_id", F.transform(F.arrays_zip(F.split("keys", ",").alias("k"), F.split("renames", ",").alias("r")),
                                         lambda x: F.struct(F.split(F.trim(x["k"]), r"\.").alias("segs"),
                                                            F.trim(x["r"]).alias("rename"))).alias("_paths")))
    payload_key = S.PAYLOAD_KEY[event_type]
    ev_web = F.try_variant_get(ev, "$.web_id", "string")
    j = base.join(maybe_broadcast(cfg), ev_web == F.col("web_id")).drop("web_id")
    j = once(j, _text=F.try_variant_get(ev, f"$.{payload_key}", "string"))
    j = once(j, _parsed=F.try_parse_json("_text"))
    payload = F.col("_parsed")
    segs0 = F.col("_paths")[0]["segs"]
    s0 = F.element_at(segs0, 1)
    # VARIANT sorts its keys: the first key in document order comes from the text
    first_key = F.get(F.json_object_keys("_text"), F.lit(0))
    first_val = _vget(payload, first_key)
    has0 = _vget(payload, s0).isNotNull()
    unwrapped = F.when((F.size(segs0) > 1) & ~has0, first_val).otherwise(payload)
    j = (once(j, _payload=unwrapped)
          .where(((F.size(segs0) > 1) | has0) & F.schema_of_variant(F.col("_payload")).startswith("OBJECT")))
    begun = F.transform("_paths", _init(F.col("_payload")))
    j = once(j, _st=F.transform(begun, lambda st: F.aggregate(F.slice(st["segs"], F.lit(2), F.size(st["segs"])), st, _step)))
    scal = F.map_from_entries(F.transform(F.filter("_st", lambda s: s["scalar"].isNotNull()),
                                          lambda s: F.struct(s["rename"], s["scalar"])))
    lists = F.filter("_st", lambda s: s["items"].isNotNull())
    n = F.size(F.element_at(F.col("_lists"), -1)["items"])
    j = (once(j, _scal=scal, _lists=lists)
          .withColumn("_i", F.explode(F.when(F.size("_lists") > 0,
                                             F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))))
                                       .otherwise(F.array(F.lit(0))))))
    j = j.where((F.size("_lists") == 0) | (n > 0))
    list_map = F.map_from_entries(F.transform("_lists", lambda s: F.struct(
        s["rename"], F.get(s["items"], F.col("_i")))))
    j = once(j, _lmap=list_map)

    def val(name: str) -> Column:
        return F.coalesce(F.try_element_at("_scal", F.lit(name)), F.try_element_at("_lmap", F.lit(name)))

    renames = F.transform("_paths", lambda p: p["rename"])
    missing = F.exists(renames, lambda r: F.coalesce(F.try_element_at("_scal", r),
                                                       F.try_element_at("_lmap", r)).isNull())
    cols = S.PURCHASE_PRODUCT_COLUMNS if event_type == "purchase" else S.PRODUCT_COLUMNS
    keep = list(keep)
    out = j.where(~missing).select(*keep, "ev", *[val(c).alias(c) for c in cols])
    # Product id rules
    pid = F.col("product_id").cast("string")
    out = out.where(pid.isNotNull() & ~pid.startswith("hitobp:product"))
    pid = F.when(pid.startswith("pufii:product"), F.regexp_replace(F.substr(pid, F.lit(15)), "^p", "P")) \
           .when(pid.startswith("wstyle:product"), F.substr(pid, F.lit(16))).otherwise(pid)
    out = out.withColumn("product_id", pid)
    if event_type == "purchase":
        out = out.withColumn("product_quantity", F.col("product_quantity"))
    out = once(out, _top=as_map(ev), _rec=record_map(ev))
    rkeys = S.RECORD_KEYS + (S.RECORD_PURCHASE_EXTRA if event_type == "purchase" else [])
    dropped = set(S.PURCHASE_DROP) if event_type == "purchase" else set()
    bad = (_m_nulls(F.col("_top"), S.UNIVERSAL_KEYS)
           | _m_nulls(F.col("_rec"), [(k, c) for k, c in rkeys if c not in dropped]))
    wide = out.select(*keep, *cols, *_m_universal(), *_m_record(event_type), bad.alias("_bad"))
    return _dedupe_columns(wide)
