"""DuckDB oracle SQL: the adapters of ``plans.adapters`` spelled in SQL, and
query texts that follow the reference's own query shapes (one join per
campaign row, GROUP BY picks made deterministic as earliest order)."""

from __future__ import annotations

import datetime as _dt

from sparktrail.plans import adapters as A

NUM = "COALESCE(TRY_CAST(NULLIF(regexp_extract({c}, '^\\s*([-+]?[0-9]*[.]?[0-9]+)', 1), '') AS DOUBLE), 0)"


def num(c: str) -> str:
    return NUM.format(c=c)


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return repr(v)


def values_cte(name: str, rows: list[tuple], schema: str) -> str:
    cols = [c.strip().split(" ")[0] for c in schema.split(",")]
    body = ",\n    ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES\n    {body}) AS t({', '.join(cols)}))"


AS_OF = A.AS_OF
AS_OF_DATE = f"DATE '{AS_OF.date().isoformat()}'"

EV = """ev AS (
  SELECT event_id AS ord, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         'w' || CAST(user_id % 5 AS VARCHAR) AS web_id,
         lpad(CAST(user_id AS VARCHAR), 36, '0') AS uuid,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         epoch_us(ts) // 1000 AS "timestamp", ts AS date_time
  FROM events)"""

U = 'web_id, uuid, session_id, "timestamp", date_time, ord'
CID = "(user_id % 5) * 7 + k % 7"
CODE = "'c' || CAST(k % 7 AS VARCHAR)"
PB = "CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END"

ROLES = {
    "load": f"""load AS (SELECT {U}, k % 3 AS device, k % 4 AS landing_count,
       CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS is_purchased_before,
       1 + k % 10 AS pageviews, k % 17 AS click_count_total, value AS time_pageview_total
       FROM ev WHERE event_type = 'view')""",
    "accept": f"""accept AS (SELECT {U}, {CID} AS coupon_id, {CODE} AS coupon_code,
       'L' || CAST({CID} AS VARCHAR) AS link_code FROM ev WHERE event_type = 'signup')""",
    "discard": f"""discard AS (SELECT {U}, {CID} AS coupon_id, {CODE} AS coupon_code FROM ev WHERE event_type = 'error')""",
    "send": f"""send AS (SELECT {U}, {CID} AS coupon_id FROM ev)""",
    "enter": f"""enter AS (SELECT {U}, {CODE} AS coupon_code FROM ev WHERE event_type = 'click')""",
    "purchase": f"""purchase AS (SELECT web_id, uuid, session_id, ord,
       epoch_ms(date_trunc('hour', ts)) AS "timestamp", date_trunc('hour', ts) AS date_time,
       CAST(value AS DECIMAL(18,2)) AS product_price, 1 + k % 3 AS product_quantity,
       CASE WHEN k % 4 = 0 THEN CAST(-1 AS DECIMAL(18,2))
            ELSE CAST(CAST(value AS DECIMAL(18,2)) * (1 + k % 3) AS DECIMAL(18,2)) END AS total_price,
       CASE WHEN k % 2 = 0 THEN {CODE} ELSE CAST(k % 5 AS VARCHAR) END AS coupon,
       CASE WHEN k % 2 = 1 THEN '1' ELSE '0' END AS avivid_coupon,
       CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE k % 9 * 10 END AS DECIMAL(18,2)) AS shipping_price,
       'p' || CAST(k % 13 AS VARCHAR) AS product_id
       FROM ev WHERE event_type = 'purchase')""",
    "clicks": f"""clicks AS (SELECT {U}, k % 11 AS recommend_type FROM ev WHERE event_type = 'click')""",
    "accept_af": f"""accept_af AS (SELECT {U}, {CID} AS ad_id FROM ev WHERE event_type = 'signup')""",
    "accept_ad": f"""accept_ad AS (SELECT {U}, {CID} AS ad_id FROM ev WHERE event_type = 'click')""",
    "send_afad": f"""send_afad AS (SELECT {U}, {CID} AS ad_id FROM ev WHERE event_type = 'view')""",
}


def tracker_roles() -> str:
    def r(name, et, extra=""):
        return f"t_{name} AS (SELECT {U}, {PB} AS is_purchased_before FROM ev WHERE event_type = '{et}'{extra})"
    return ",\n".join([r("load", "view"), r("leave", "click"), r("timeout", "error"),
                       r("addCart", "signup"), r("removeCart", "error", " AND k % 2 = 0"),
                       r("purchase", "purchase")])


def dims(cells=None) -> str:
    return ",\n".join([
        values_cte("campaigns", A.campaign_rows(), A.CAMPAIGN_SCHEMA),
        values_cte("addfan_stat", A.addfan_stat_rows(), "web_id STRING, avg_shipping_price INT, avg_total_price INT"),
        values_cte("settings", A.settings_rows(cells), A.SETTINGS_SCHEMA),
    ])


def prefix(cells=None, extra: list[str] | None = None) -> str:
    parts = [EV, *ROLES.values(), tracker_roles(), dims(cells)]
    parts += extra or []
    return "WITH " + ",\n".join(parts)


ACTIVITY = """act AS (SELECT id, web_id, link_code, coupon_type, coupon_amount,
       start_time AS activity_start, end_time + 1 AS activity_end, coupon_total, coupon_used,
       CASE WHEN instr(coupon_limit, 'limit-bill=') > 0
            THEN COALESCE(TRY_CAST(split_part(coupon_limit, 'limit-bill=', 2) AS INTEGER), 0) ELSE 0 END AS coupon_price_limit,
       ad_url, ad_btn_url
     FROM campaigns)"""

CAMP = """camp AS (SELECT a.*, COALESCE(s.type_total_price, 0) AS tt, COALESCE(s.type_cal_cost, 0) AS cc,
       TRY_CAST(a.coupon_amount AS DOUBLE) AS amount,
       CASE a.coupon_type WHEN 1 THEN CAST(st.avg_shipping_price AS BIGINT)
            WHEN 2 THEN CAST(floor(TRY_CAST(a.coupon_amount AS DOUBLE)) AS BIGINT)
            WHEN 3 THEN -1 ELSE 100 END AS unit_cost
     FROM act a LEFT JOIN (SELECT * FROM settings WHERE enable_analysis = 1) s ON s.web_id = a.web_id
     LEFT JOIN addfan_stat st ON st.web_id = a.web_id)"""


def _ts(d: str) -> str:
    return f"CAST({d} AS TIMESTAMP)"


def _win(col: str, lo: str | None, hi: str | None) -> str:
    out = []
    if lo:
        out.append(f"{col} >= {_ts(lo)}")
    if hi:
        out.append(f"{col} <= {_ts(hi)}")
    return " AND ".join(out) if out else "TRUE"


def _cell_pairs(tt: int, cc: int, web_ids: list[str], daily: bool, grain_from: str, windowing: str = "reference") -> str:
    """SQL for the (campaign[, day], visitor, order session) pairs of one cell,
    one row per pair with its earliest joined order."""
    g = "c.id AS cid" + (", c.d" if daily else "")
    gkeys = "c.id" + (", c.d" if daily else "")
    if daily:
        s, e, s1 = "c.d", "c.d + 1", "c.d - 1"
        two_sided = cc == 3 and (tt == 0 or windowing == "dated")
        acc = _win("a.date_time", s, e) if two_sided else _win("a.date_time", s1, None)
        pur = _win("p.date_time", s, e)
        ent = _win("e.date_time", s1, None)
        price_pos = tt == 0 and cc in (1, 2, 3, 4, 5)
    else:
        s, e = "c.activity_start", "c.activity_end"
        dated = tt == 0 or cc in (4, 5)
        lo = s if dated else None
        hi = e if (dated and cc != 4) else None
        acc, pur, ent = _win("a.date_time", lo, hi), _win("p.date_time", lo, hi), _win("e.date_time", lo, hi)
        price_pos = False
    filt = []
    if cc == 1:
        filt.append(f"{num('p.coupon')} != 0")
    if cc == 3:
        filt.append("p.avivid_coupon = '1'")
    if price_pos:
        filt.append("p.product_price > 0")
    lf = " AND ".join([pur] + filt)
    if tt == 0:
        orders = f"""SELECT {g}, p.uuid, p.session_id, p."timestamp", min(p.ord) AS ord,
              SUM(p.product_price * p.product_quantity) AS total,
              AVG(ABS({num('p.coupon')})) AS coupon_val, arg_min(p.coupon, p.ord) AS coupon
            FROM {grain_from} JOIN purchase p ON p.web_id = c.web_id AND {lf}
            GROUP BY {gkeys}, c.coupon_price_limit, p.uuid, p.session_id, p."timestamp"
            HAVING SUM(p.product_price * p.product_quantity) > c.coupon_price_limit"""
    else:
        orders = f"""SELECT {g}, p.uuid, p.session_id, p."timestamp", p.ord, p.total_price AS total,
              ABS({num('p.coupon')}) AS coupon_val, p.coupon
            FROM {grain_from} JOIN purchase p ON p.web_id = c.web_id AND {lf}
              AND p.total_price > c.coupon_price_limit"""
    on = "a.uuid = b.uuid" + ("" if cc == 4 else " AND a.session_id = b.session_id")
    if cc == 2:
        on += " AND a.coupon_code = b.coupon"
    enter = ""
    if cc in (4, 5):
        es = "" if cc == 4 else " AND e.session_id = a.session_id"
        enter = (f"JOIN enter e ON e.web_id = c.web_id AND e.uuid = a.uuid{es} "
                 f"AND e.coupon_code = a.coupon_code AND {ent}")
    bkey = "b.cid = c.id" + (" AND b.d = c.d" if daily else "")
    return f"""SELECT {g}, a.uuid, b.session_id AS session_b,
          arg_min(b.total, (b."timestamp", b.ord)) AS total,
          arg_min(b.coupon_val, (b."timestamp", b.ord)) AS coupon_val
        FROM {grain_from}
        JOIN accept a ON a.web_id = c.web_id AND a.coupon_id = c.id AND {acc}
        JOIN ({orders}) b ON {bkey} AND {on}
        {enter}
        GROUP BY {gkeys}, a.uuid, b.session_id"""


def _in(web_ids: list[str]) -> str:
    return "(" + ", ".join(_lit(w) for w in web_ids) + ")"


def _cost_sql(tt: int, cc: int, rev: str, used: str, csum: str) -> str:
    base = csum if (tt == 0 and cc == 1) else f"{used} * c.unit_cost"
    return (f"CASE WHEN c.coupon_type = 3 THEN floor(floor({rev}) * (10 - c.amount) / 10) "
            f"ELSE {base} END")


def lifetime_cell(tt: int, cc: int, web_ids: list[str]) -> str:
    """SELECT body: (coupon_id, web_id, revenue, cost, coupon_used) for the
    campaigns of ``web_ids`` under cell (tt, cc)."""
    pairs = _cell_pairs(tt, cc, web_ids, False, f"(SELECT * FROM camp WHERE web_id IN {_in(web_ids)}) c")
    rev, used, csum = "COALESCE(SUM(p.total), 0)", "COUNT(p.total)", "COALESCE(SUM(p.coupon_val), 0)"
    return f"""SELECT c.id AS coupon_id, c.web_id, CAST({rev} AS DOUBLE) AS revenue,
      CAST({_cost_sql(tt, cc, rev, used, csum)} AS DOUBLE) AS cost,
      CAST({used} AS BIGINT) AS coupon_used
    FROM (SELECT * FROM camp WHERE web_id IN {_in(web_ids)}) c
    LEFT JOIN ({pairs}) p ON p.cid = c.id
    GROUP BY c.id, c.web_id, c.coupon_type, c.amount, c.unit_cost"""


def daily_cell(tt: int, cc: int, web_ids: list[str], windowing: str = "reference") -> str:
    """SELECT body: (coupon_id, d, revenue, coupon_used, coupon_sum) per
    campaign day of the cell."""
    src = f"(SELECT * FROM days WHERE web_id IN {_in(web_ids)}) c"
    if tt != 0 and cc not in (4, 5) and windowing == "reference":
        pairs = _cell_pairs(tt, cc, web_ids, False, f"(SELECT * FROM camp WHERE web_id IN {_in(web_ids)}) c")
        return f"""SELECT c.id AS coupon_id, c.d, COALESCE(SUM(p.total), 0) AS revenue,
          COUNT(p.total) AS coupon_used, COALESCE(SUM(p.coupon_val), 0) AS coupon_sum
        FROM {src} LEFT JOIN ({pairs}) p ON p.cid = c.id GROUP BY c.id, c.d"""
    pairs = _cell_pairs(tt, cc, web_ids, True, src, windowing)
    return f"""SELECT c.id AS coupon_id, c.d, COALESCE(SUM(p.total), 0) AS revenue,
      COUNT(p.total) AS coupon_used, COALESCE(SUM(p.coupon_val), 0) AS coupon_sum
    FROM {src} LEFT JOIN ({pairs}) p ON p.cid = c.id AND p.d = c.d GROUP BY c.id, c.d"""


DAYS = f"""days AS (SELECT c.*, CAST(g.d AS DATE) AS d FROM camp c,
      LATERAL (SELECT unnest(generate_series(CAST(c.activity_start AS TIMESTAMP),
               CAST(least(c.activity_end, {AS_OF_DATE}) AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g)"""


def roas_lifetime_sql(cells: dict[str, tuple[int, int]]) -> str:
    groups: dict[tuple[int, int], list[str]] = {}
    for w, cell in cells.items():
        groups.setdefault(cell, []).append(w)
    body = "\nUNION ALL\n".join(lifetime_cell(tt, cc, ws) for (tt, cc), ws in sorted(groups.items()))
    return prefix(cells, [ACTIVITY, CAMP]) + "\n" + body


def roas_daily_sql(cells: dict[str, tuple[int, int]], windowing: str = "reference") -> str:
    groups: dict[tuple[int, int], list[str]] = {}
    for w, cell in cells.items():
        groups.setdefault(cell, []).append(w)
    used = "\nUNION ALL\n".join(daily_cell(tt, cc, ws, windowing) for (tt, cc), ws in sorted(groups.items()))
    acc = f"""acc_d AS (SELECT c.id AS coupon_id, CAST(a.date_time AS DATE) AS d, COUNT(DISTINCT a.uuid) AS coupon_accepted
      FROM camp c JOIN accept a ON a.web_id = c.web_id AND a.coupon_id = c.id
        AND a.date_time BETWEEN CAST(c.activity_start AS TIMESTAMP)
                            AND CAST(least(c.activity_end, {AS_OF_DATE}) + 1 AS TIMESTAMP)
      WHERE c.activity_start <= least(c.activity_end, {AS_OF_DATE})
      GROUP BY 1, 2)"""
    imp = """imp_d AS (SELECT c.id AS coupon_id, c.d, COUNT(DISTINCT x.uuid) AS coupon_imp
      FROM days c JOIN (SELECT web_id, coupon_id, uuid, date_time FROM accept
                        UNION ALL SELECT web_id, coupon_id, uuid, date_time FROM discard) x
        ON x.web_id = c.web_id AND x.coupon_id = c.id
       AND x.date_time BETWEEN CAST(c.d AS TIMESTAMP) AND CAST(c.d + 1 AS TIMESTAMP)
      GROUP BY 1, 2)"""
    grid = """grid AS (SELECT id AS coupon_id, d FROM days UNION SELECT coupon_id, d FROM acc_d)"""
    q = prefix(cells, [ACTIVITY, CAMP, DAYS, f"used AS ({used})", acc, imp, grid])
    rev, used_n, csum = "COALESCE(u.revenue, 0)", "COALESCE(u.coupon_used, 0)", "COALESCE(u.coupon_sum, 0)"
    cost_parts = []
    for (tt, cc), ws in sorted(groups.items()):
        cost_parts.append(f"WHEN c.web_id IN {_in(ws)} THEN {_cost_sql(tt, cc, rev, used_n, csum)}")
    cost = "CASE " + " ".join(cost_parts) + " END"
    return q + f"""
    SELECT g.coupon_id, c.web_id, g.d AS date_time,
      CAST(COALESCE(a.coupon_accepted, 0) AS BIGINT) AS coupon_accepted,
      CAST(COALESCE(i.coupon_imp, 0) AS BIGINT) AS coupon_imp,
      CAST({used_n} AS BIGINT) AS coupon_used,
      CAST(floor({rev}) AS BIGINT) AS revenue,
      CAST(floor({cost}) AS BIGINT) AS cost
    FROM grid g JOIN camp c ON c.id = g.coupon_id
    LEFT JOIN used u ON u.coupon_id = g.coupon_id AND u.d = g.d
    LEFT JOIN acc_d a ON a.coupon_id = g.coupon_id AND a.d = g.d
    LEFT JOIN imp_d i ON i.coupon_id = g.coupon_id AND i.d = g.d"""


def order_rev_sql(src: str, key: list[str]) -> str:
    """A13 in SQL: last positive-total line sets the value, later lines add."""
    k = ", ".join(key)
    return f"""(WITH l AS (SELECT {k}, ord,
          GREATEST(total_price, 0) AS tot,
          CASE WHEN product_price = -1 THEN 0 ELSE product_price END
            * GREATEST(product_quantity, 0) AS val FROM {src}),
        lst AS (SELECT {k}, max(CASE WHEN tot > 0 THEN ord END) AS last_ord FROM l GROUP BY {k})
      SELECT {k}, COALESCE(MAX(CASE WHEN l.ord = lst.last_ord THEN l.tot END), 0)
               + COALESCE(SUM(CASE WHEN lst.last_ord IS NULL OR l.ord > lst.last_ord THEN l.val END), 0) AS revenue
      FROM l JOIN lst USING ({k}) GROUP BY {k})"""
