"""Raw tracker objects derived from the driver ``events`` table, so the
decode + flatten pipeline (S05, P01-P14) runs over data that grows with
the given tables.

Each events row becomes one raw JSON document; documents of one minute
and one range of ``IDS_PER_OBJECT`` event ids form one object (concatenated
with junk tags, as the tracker writes them), so that an object is bounded.
``SECOND_TYPES`` makes the coupon and advertisement types of the same rows. Rules by ``k`` (= props.k) exercise the edge cases:
  ga_id missing when k % 10 = 3;  fb_id JSON null when k % 23 = 5;
  uuid 37 chars when k % 31 = 7;  record_user missing when k % 13 = 0,
  else an object (even event_id) or a JSON string (odd);
  coupon_info missing when k % 19 = 0; empty code when k % 9 = 0;
  click_info.type missing when k % 5 = 0.
``_ord`` (the event id) travels in each document as the row identity.

The expected clean rows are spelled in DuckDB SQL by ``expected_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktrail import schemas as S
from sparktrail.plans.sizing import ROWS_PER_TASK

CLICK_NAMES = list(S.CLICK_TYPE_BASE) + ["other_click"]

# Payload contents (raw key -> expression over the base events) - the rest
# of each key map is missing in the documents and flattens to -1.
LOAD_PRESENT = {"dv": "k % 3", "ps": "1 + k % 10", "s_id": "session_id", "l_c": "k % 3",
                "c_c_t": "k % 17", "t_p_t": "CAST(k * 7 AS INTEGER)", "i_pb": "CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END",
                "ul": "'u' || CAST(k AS STRING)"}
RECORD_PRESENT = {"dv": "k % 3", "ps": "1 + k % 10", "s_id": "session_id", "l_c": "k % 3", "c_c_t": "k % 17",
                  "t_p_t": "CAST(k * 7 AS INTEGER)", "i_pb": "CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END"}
ACCEPT_PRESENT = {"c_i": "(user_id % 5) * 7 + k % 7", "c_c": "'c' || CAST(k % 7 AS STRING)",
                  "l_c": "'L' || CAST((user_id % 5) * 7 + k % 7 AS STRING)", "c_ty": "k % 5"}
ENTER_PRESENT = {"s_id": "session_id", "code": "CASE WHEN k % 9 = 0 THEN '' ELSE 'c' || CAST(k % 7 AS STRING) END"}

SEND_PRESENT = {"l_b": "k % 5", "u_b": "k % 7", "m_k": "array('a', CAST(k % 3 AS STRING))", "m_X": "k % 11", "c_i": "k % 7",
                "c_c_t": "k % 5"}
AFAD_PRESENT = {"a_i": "k % 4", "w_t": "k % 2"}
SCROLLED = "array(k % 3, k % 5)"  # a list in the record of the second types

IDS_PER_OBJECT = 256
#: Objects that are written as files, one each: some MB at most, as each file has a cost of its own.
IDS_PER_FILE = 4096
#: Documents with this remainder of the event id by 50 repeat a key in broken objects.
BROKEN = 7

PURCHASE_KEYS = "order_id,items.id,items.price,items.qty"
PURCHASE_RENAMES = "order_id,product_id,product_price,product_quantity"
WRAPPED_KEYS = "items.id,items.price,items.qty,order_id"
WRAPPED_RENAMES = "product_id,product_price,product_quantity,order_id"


def _raw_type(k: Column) -> Column:
    names = F.array(*[F.lit(n) for n in CLICK_NAMES])
    et = F.col("event_type")
    return (F.when(et == "view", "load").when(et == "signup", "acceptCoupon")
             .when(et == "error", F.when(k % 2 == 0, "leave").otherwise("timeout"))
             .when(et == "purchase", "purchase")
             .when(et == "click", F.when(k % 2 == 0, "enterCoupon").otherwise(F.element_at(names, (k % 11) + 1))))


#: Event type of the second documents, for the events table's own types (two: even and odd k).
SECOND_TYPES = {"purchase": ("addCart", "removeCart"), "view": ("sendCoupon",), "signup": ("discardCoupon",), "error": ("sendAfAd", "acceptAf"),
                "click": ("acceptAd",)}


def second_documents(ev: DataFrame) -> DataFrame:
    """(event_id, ts, doc) of the cart, coupon and advertisement types; ``coupon_info`` is missing when k % 19 = 0,
    ``afad_info`` and the carts when k % 17 = 0, ``record_user`` when k % 13 = 0."""
    k, et = F.col("k"), F.col("event_type")
    rt = F.lit(None).cast("string")
    for own, names in SECOND_TYPES.items():
        rt = F.when(et == own, F.when(k % 2 == 0, names[0]).otherwise(names[-1])).otherwise(rt)
    given = lambda keys: F.struct(*[F.expr(v).alias(key) for key, v in keys.items()])
    as_variant = lambda keys: F.parse_json(F.to_json(given(keys)))
    coupon = F.when(k % 19 != 0, F.when(rt == "sendCoupon", as_variant(SEND_PRESENT)).when(
        rt == "discardCoupon", as_variant(ACCEPT_PRESENT)))
    afad = F.when((k % 17 != 0) & rt.isin("sendAfAd", "acceptAf", "acceptAd"), given(AFAD_PRESENT))
    there = k % 17 != 0
    cart = F.when(there & (rt == "addCart"), F.struct(
        F.concat(F.lit("p"), (k % 13).cast("string")).alias("id"), (k * 3).alias("price"), (1 + k % 3).alias("qty")))
    item = lambda i: F.struct(F.concat(F.lit("p"), ((k + i) % 13).cast("string")).alias("id"),
                              F.concat(F.lit("NT$"), ((k + i) * 2).cast("string")).alias("price"))
    left = F.to_json(F.struct(F.transform(F.sequence(F.lit(0), k % 3), item).alias("items")))
    removed = F.when(there & (rt == "removeCart"), left)  # a JSON text, as purchases are
    doc = F.to_json(F.struct(
        F.col("ord").alias("_ord"), "web_id", cart.alias(S.PAYLOAD_KEY["addCart"]), removed.alias(S.PAYLOAD_KEY["removeCart"]),
        F.when(k % 31 == 7, F.concat(F.lit("x"), F.col("uuid"))).otherwise(F.col("uuid")).alias("uuid"),
        F.when(k % 10 != 3, F.concat(F.lit("GA"), F.col("user_id").cast("string"))).alias("ga_id"),
        F.when(k % 23 == 5, F.lit("__NULL__")).otherwise(F.concat(F.lit("fb"), F.col("user_id").cast("string"))).alias("fb_id"),
        "timestamp", (k % 2).cast("string").alias("coupon"), rt.alias("event_type"),
        F.when(k % 13 != 0, given(RECORD_PRESENT | {"mt_nsa": SCROLLED})).alias("record_user"),
        coupon.alias("coupon_info"), afad.alias("afad_info")))
    return ev.where(rt.isNotNull()).select(F.col("ord").alias("event_id"), "ts",
                                           F.regexp_replace(doc, '"__NULL__"', "null").alias("doc"), *_part_of(ev))


def _variant_of_text(text: Column) -> Column:
    """A VARIANT holding a JSON string."""
    return F.try_variant_get(F.parse_json(F.to_json(F.array(text))), "$[0]", "variant")


def _items(k: Column) -> Column:
    def item(i):
        ki = k + i
        pid = (F.when(ki % 17 == 0, F.concat(F.lit("hitobp:product"), i.cast("string")))
                .when(ki % 19 == 0, F.concat(F.lit("pufii:product:p"), F.lpad(k.cast("string"), 4, "0")))
                .when(ki % 23 == 0, F.concat(F.lit("wstyle:product:"), k.cast("string")))
                .otherwise(F.concat(F.lit("p"), (ki % 13).cast("string"))))
        price = (F.when(ki % 4 == 0, F.concat(F.lit("NT$"), (F.col("value") * 10).cast("int").cast("string")))
                  .when(ki % 4 == 1, F.col("value").cast("decimal(10,2)").cast("string"))
                  .otherwise((F.col("value")).cast("int").cast("string")))
        return F.struct(pid.alias("id"), price.alias("price"), (1 + ki % 3).alias("qty"))
    return F.transform(F.sequence(F.lit(0), k % 3), item)


def raw_documents(ev: DataFrame) -> DataFrame:
    """(event_id, ts, doc) - one tracker JSON document per events row.
    ``ev`` = ``adapters.base_events``."""
    k = F.col("k")
    rt = _raw_type(k)
    rec = F.struct(*[F.expr(v).alias(kk) for kk, v in RECORD_PRESENT.items()])
    rec_text = F.to_json(rec)
    record = (F.when(k % 13 == 0, F.lit(None).cast("variant"))
               .when(F.col("ord") % 2 == 0, F.parse_json(rec_text)).otherwise(_variant_of_text(rec_text)))
    load = F.when(rt == "load", F.struct(*[F.expr(v).alias(kk) for kk, v in LOAD_PRESENT.items()]))
    acc = F.parse_json(F.to_json(F.struct(*[F.expr(v).alias(kk) for kk, v in ACCEPT_PRESENT.items()])))
    ent = F.parse_json(F.to_json(F.struct(*[F.expr(v).alias(kk) for kk, v in ENTER_PRESENT.items()])))
    coupon_info = (F.when(k % 19 == 0, F.lit(None).cast("variant"))
                    .when(rt == "acceptCoupon", acc).when(rt == "enterCoupon", ent))
    body = F.struct(F.concat(F.lit("o"), F.col("ord").cast("string")).alias("order_id"), _items(k).alias("items"))
    body_text = F.when(F.col("web_id") == "w1", F.to_json(F.struct(body.alias("data")))).otherwise(F.to_json(body))
    purchase = F.when(rt == "purchase", body_text)
    click = F.when(rt.isin(*CLICK_NAMES), F.struct(
        F.col("session_id").alias("s_id"), (k % 3).alias("dv"), F.when(k % 5 != 0, k % 3).alias("type")))
    doc = F.to_json(F.struct(
        F.col("ord").alias("_ord"), F.col("web_id"),
        F.when(k % 31 == 7, F.concat(F.lit("x"), F.col("uuid"))).otherwise(F.col("uuid")).alias("uuid"),
        F.when(k % 10 != 3, F.concat(F.lit("GA"), F.col("user_id").cast("string"))).alias("ga_id"),
        F.when(k % 23 == 5, F.lit("__NULL__")).otherwise(F.concat(F.lit("fb"), F.col("user_id").cast("string"))).alias("fb_id"),
        F.col("timestamp"), (k % 2).cast("string").alias("coupon"), rt.alias("event_type"),
        load.alias("load"), F.when(rt != "load", record).alias("record_user"), coupon_info.alias("coupon_info"),
        purchase.alias("purchase"), click.alias("click_info")))
    doc = F.regexp_replace(doc, '"__NULL__"', "null")
    return ev.select(F.col("ord").alias("event_id"), "ts", doc.alias("doc"), *_part_of(ev))


def _part_of(ev: DataFrame) -> list[Column]:
    return [F.col("part")] if "part" in ev.columns else []


def filled_parts(ev: DataFrame, pattern: str, ids: int) -> DataFrame:
    """``ev`` with the object (``part``) of its time that a row goes to: in the order of their ids, an object has ``ids``
    rows, up to the end of a run of ``IDS_PER_OBJECT`` ids. Objects by ranges of ids are as many as there are ranges, however
    few of a range's ids belong to a time."""
    rows = ev.select("*", F.date_format("ts", pattern).alias("_path"), F.floor(F.col("ord") / IDS_PER_OBJECT).alias("_run"))
    runs = rows.groupBy("_path", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_path").orderBy("_run")) - F.col("_n")
    runs = runs.select(F.col("_path").alias("_p"), F.col("_run").alias("_r"), F.floor(before / ids).alias("part"))
    same = F.col("_path").eqNullSafe(F.col("_p")) & F.col("_run").eqNullSafe(F.col("_r"))
    return rows.join(runs, same).drop("_path", "_run", "_p", "_r")


def raw_objects(ev: DataFrame, documents=raw_documents, broken: bool = False, pattern: str = "yyyy/MM/dd/HH/mm",
                ids: int = IDS_PER_OBJECT, rows: int = 0) -> DataFrame:
    """(path, text): objects of concatenated documents with junk, of ``ids`` event ids at most, or those named by
    ``part`` where ``ev`` has it; if ``broken``, some documents repeat a key and can't be read. ``pattern``: the time that
    objects are named by. ``rows``: how many ``ev`` has, if known.

    The rows are dealt out first: a few bytes each in the table, they are read by few tasks, and writing
    documents is nearly all of the work."""
    doc = F.col("doc")
    if broken:
        doc = F.when(F.col("event_id") % 50 == BROKEN, F.regexp_replace(doc, r"^\{", '{"_ord":0,')).otherwise(doc)
    junk = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('"landing"'), doc)).otherwise(doc)
    part = F.col("part") if "part" in ev.columns else F.floor(F.col("event_id") / ids).alias("part")
    tasks = max(4 * ev.sparkSession.sparkContext.defaultParallelism, rows // ROWS_PER_TASK)
    spread = ev.repartition(tasks, "ord", "ts")
    g = documents(spread).groupBy(F.date_format("ts", pattern).alias("path"), part).agg(
        F.array_sort(F.collect_list(F.struct("event_id", junk.alias("t")))).alias("_docs"))
    text = F.concat_ws("", F.transform("_docs", lambda x: x["t"]))
    tail = F.when(F.element_at("_docs", 1)["event_id"] % 3 == 0, F.lit('"]"')).otherwise(F.lit(""))
    return g.select("path", F.concat(text, tail).alias("text"), "part")


def write_objects(objects: DataFrame, root: str) -> None:
    """One file per object, as the tracker has them, under ``dt=/hour=`` of the object's time (path: day and hour)."""
    at = F.to_timestamp("path", "yyyy/MM/dd/HH")
    rows = objects.select("text", F.to_date(at).alias("dt"), F.hour(at).alias("hour"),
                          F.concat(F.lit("object-"), F.lpad(F.col("part").cast("string"), 12, "0")).alias("name"))
    # rebalance: a task has some MB of objects, as it sorts them
    rows = rows.hint("rebalance", *[F.col(c) for c in ("dt", "hour", "name")])
    rows.write.mode("append").partitionBy("dt", "hour", "name").text(root)


CART_KEYS, CART_RENAMES = "id,price,qty", "product_id,product_price,product_quantity"
REMOVED_KEYS, REMOVED_RENAMES = "items.id,items.price", "product_id,product_price"


def tracker_settings(spark) -> DataFrame:
    """The tenants' settings with the paths of their product events (F14's columns)."""
    from sparktrail.plans.adapters import settings
    wrapped = F.col("web_id") == "w1"
    return (settings(spark)
            .withColumn("parsed_purchase_key", F.when(wrapped, WRAPPED_KEYS).otherwise(PURCHASE_KEYS))
            .withColumn("parsed_purchase_key_rename", F.when(wrapped, WRAPPED_RENAMES).otherwise(PURCHASE_RENAMES))
            .withColumn("parsed_addCart_key", F.lit(CART_KEYS)).withColumn("parsed_addCart_key_rename", F.lit(CART_RENAMES))
            .withColumn("parsed_removeCart_key", F.lit(REMOVED_KEYS))
            .withColumn("parsed_removeCart_key_rename", F.lit(REMOVED_RENAMES)))


def product_settings(spark) -> DataFrame:
    from sparktrail.operators.products import product_path_settings
    return product_path_settings(tracker_settings(spark))


# ------------------------------------------------------------ DuckDB side
def _sent(v: str | None) -> str:
    return v if v is not None else "'-1'"


def _txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


UNIVERSAL_SQL = {
    "web_id": "web_id",
    "uuid": "CASE WHEN k % 31 = 7 THEN 'x' || uuid ELSE uuid END",
    "ga_id": "CASE WHEN k % 10 = 3 THEN '_' ELSE 'GA' || CAST(user_id AS VARCHAR) END",
    "fb_id": "CASE WHEN k % 23 = 5 THEN NULL ELSE 'fb' || CAST(user_id AS VARCHAR) END",
    "timestamp": 'CAST("timestamp" AS VARCHAR)',
    "avivid_coupon": "CAST(k % 2 AS VARCHAR)",
}


def _record_cols(extra: bool = False, scrolled: bool = False) -> list[str]:
    keys = S.RECORD_KEYS + (S.RECORD_PURCHASE_EXTRA if extra else [])
    out = []
    for raw, col in keys:
        if scrolled and raw == "mt_nsa":
            out.append(f"CASE WHEN k % 13 = 0 THEN '-1' ELSE {_txt('k % 3')} || ',' || {_txt('k % 5')} END AS {col}")
        elif raw in RECORD_PRESENT:
            out.append(f"CASE WHEN k % 13 = 0 THEN '-1' ELSE {_txt(RECORD_PRESENT[raw])} END AS {col}")
        else:
            out.append(f"'-1' AS {col}")
    return out


def _uni() -> list[str]:
    return [f"{v} AS {c}" for c, v in UNIVERSAL_SQL.items()]


DT = "make_timestamp(\"timestamp\" * 1000) + INTERVAL 8 HOUR AS date_time"
RAW_TYPE = ("CASE event_type WHEN 'view' THEN 'load' WHEN 'signup' THEN 'acceptCoupon' "
            "WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'leave' ELSE 'timeout' END "
            "WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'enterCoupon' "
            "ELSE list_extract([" + ", ".join(f"'{n}'" for n in CLICK_NAMES) + "], (k % 11) + 1) END END")
GUARD = "k % 23 != 5 AND k % 31 != 7"


SECOND_RAW_TYPE = "CASE event_type " + " ".join(
    f"WHEN '{own}' THEN CASE WHEN k % 2 = 0 THEN '{names[0]}' ELSE '{names[-1]}' END"
    for own, names in SECOND_TYPES.items()) + " END"


def second_sql(event_type: str) -> str:
    """SELECT of the clean rows of one of the second types from the ``ev`` CTE."""
    if event_type in ("addCart", "removeCart"):
        many = event_type == "removeCart"
        at = "(k + i)" if many else "k"
        own = {"product_id": f"'p' || CAST({at} % 13 AS VARCHAR)", "product_price": "'NT$' || CAST((k + i) * 2 AS VARCHAR)" if many else "CAST(k * 3 AS VARCHAR)",
               "product_quantity": "NULL" if many else "CAST(1 + k % 3 AS VARCHAR)"}
        cols = [f"{own.get(c, 'NULL')} AS {c}" for c in S.PRODUCT_COLUMNS]
        rows = "SELECT *, unnest(generate_series(0, k % 3)) AS i FROM ev" if many else "SELECT * FROM ev"
        return (f"SELECT ord, {', '.join(cols + _uni() + _record_cols(scrolled=True))}, {DT} "
                f"FROM (SELECT *, {SECOND_RAW_TYPE} AS rt FROM ({rows})) e "
                f"WHERE rt = '{event_type}' AND k % 17 != 0 AND {GUARD}")
    keys, given, there = ((S.SEND_COUPON_KEYS, SEND_PRESENT, "k % 19 != 0") if event_type == "sendCoupon" else
                          (S.ACCEPT_COUPON_KEYS, ACCEPT_PRESENT, "k % 19 != 0") if event_type == "discardCoupon" else
                          (S.AFAD_KEYS, AFAD_PRESENT, "k % 17 != 0"))
    lists = {"model_keys": "'a,' || CAST(k % 3 AS VARCHAR)", "model_parameters": "'_'", "model_X": "'_'"}
    cols = [f"{lists[c] if c in lists else _txt(given[r]) if r in given else chr(39) + '-1' + chr(39)} AS {c}"
            for r, c in keys]
    record = [c for c in _record_cols(scrolled=True)
              if event_type != "sendCoupon" or c.split(" AS ")[-1] not in S.SEND_COUPON_DROP]
    return (f"SELECT ord, {', '.join(_uni() + cols + record)}, {DT} FROM (SELECT *, {SECOND_RAW_TYPE} AS rt FROM ev) e "
            f"WHERE rt = '{event_type}' AND {there} AND {GUARD}")


def expected_sql(event_type: str) -> str:
    """SELECT of the clean rows of one event type from the ``ev`` CTE."""
    src = f"(SELECT *, {RAW_TYPE} AS rt FROM ev) e"
    if event_type == "load":
        cols = [f"{_txt(LOAD_PRESENT[r]) if r in LOAD_PRESENT else chr(39) + '-1' + chr(39)} AS {c}" for r, c in S.LOAD_KEYS]
        return f"SELECT ord, {', '.join(_uni() + cols)}, {DT} FROM {src} WHERE rt = 'load' AND {GUARD}"
    if event_type in ("leave", "timeout"):
        return (f"SELECT ord, {', '.join(_uni() + _record_cols())}, {DT} FROM {src} "
                f"WHERE rt = '{event_type}' AND {GUARD}")
    if event_type == "acceptCoupon":
        cols = [f"{_txt(ACCEPT_PRESENT[r]) if r in ACCEPT_PRESENT else chr(39) + '-1' + chr(39)} AS {c}"
                for r, c in S.ACCEPT_COUPON_KEYS]
        return (f"SELECT ord, {', '.join(_uni() + cols + _record_cols())}, {DT} FROM {src} "
                f"WHERE rt = 'acceptCoupon' AND k % 19 != 0 AND {GUARD}")
    if event_type == "enterCoupon":
        cols = [f"{_txt(ENTER_PRESENT[r])} AS {c}" for r, c in S.ENTER_COUPON_KEYS]
        return (f"SELECT ord, {', '.join(_uni() + cols)}, {DT} FROM {src} "
                f"WHERE rt = 'enterCoupon' AND k % 19 != 0 AND k % 9 != 0 AND {GUARD}")
    if event_type == "clicks":
        base = "CASE rt " + " ".join(f"WHEN '{n}' THEN {b}" for n, b in S.CLICK_TYPE_BASE.items()) + " END"
        return f"""SELECT ord, web_id, {UNIVERSAL_SQL['uuid']} AS uuid,
            CASE WHEN k % 10 = 3 THEN '_' ELSE 'GA' || CAST(user_id AS VARCHAR) END AS ga_id,
            CASE WHEN k % 23 = 5 THEN NULL ELSE 'fb' || CAST(user_id AS VARCHAR) END AS fb_id,
            '_' AS ip, CAST("timestamp" AS VARCHAR) AS "timestamp",
            session_id, '_' AS session_id_last, CAST(k % 3 AS VARCHAR) AS device, '_' AS url_last, '_' AS url_now,
            {base} + CASE WHEN k % 5 != 0 THEN k % 3 ELSE 0 END AS recommend_type, '_' AS label, {DT}
          FROM {src} WHERE rt IN ({', '.join(chr(39) + n + chr(39) for n in S.CLICK_TYPE_BASE)})"""
    if event_type == "purchase":
        price_txt = ("CASE WHEN (k + i) % 4 = 0 THEN 'NT$' || CAST(CAST(trunc(value * 10) AS INTEGER) AS VARCHAR) "
                     "WHEN (k + i) % 4 = 1 THEN CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) "
                     "ELSE CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR) END")
        pid = ("CASE WHEN (k + i) % 17 = 0 THEN NULL "
               "WHEN (k + i) % 19 = 0 THEN regexp_replace(substr(lpad(CAST(k AS VARCHAR), 4, '0'), 1), '^', 'P') "
               "WHEN (k + i) % 23 = 0 THEN CAST(k AS VARCHAR) "
               "ELSE 'p' || CAST((k + i) % 13 AS VARCHAR) END")
        price = ("CASE WHEN regexp_matches(pt, '^-?[0-9]+$') THEN CAST(pt AS BIGINT) "
                 "ELSE COALESCE(CAST(trunc(TRY_CAST(array_to_string(regexp_extract_all(pt, '[0-9.]+'), '') AS DOUBLE)) AS BIGINT), -1) END")
        rec = [c for c in _record_cols(True) if c.split(" AS ")[-1] not in S.PURCHASE_DROP]
        prod = [f"{pid} AS product_id", "NULL AS product_name", "pt", "CAST(1 + (k + i) % 3 AS VARCHAR) AS product_quantity",
                "NULL AS product_category", "NULL AS product_category_name", "NULL AS product_variant",
                "NULL AS coupon", "NULL AS currency", "'o' || CAST(ord AS VARCHAR) AS order_id",
                "NULL AS total_price", "NULL AS shipping_price"]
        inner = (f"SELECT ord, k, i, {', '.join(prod)}, {', '.join(_uni() + rec)}, {DT} "
                 f"FROM (SELECT e.*, unnest(generate_series(0, k % 3)) AS i FROM {src} WHERE rt = 'purchase' AND {GUARD}) x")
        inner = inner.replace(" pt,", f" {price_txt} AS pt,")
        cols = ["ord", "product_id", "product_name", f"{price} AS product_price", "product_quantity",
                "product_category", "product_category_name", "product_variant", "coupon", "currency", "order_id",
                "CAST(-1 AS BIGINT) AS total_price", "CAST(-1 AS BIGINT) AS shipping_price"]
        cols += [c for c in UNIVERSAL_SQL] + [c.split(" AS ")[-1] for c in rec] + ["date_time"]
        return f"SELECT {', '.join(cols)} FROM ({inner}) y WHERE product_id IS NOT NULL"
    raise ValueError(event_type)
