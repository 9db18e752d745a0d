"""DuckDB twins of the split and of the fitted curves: the recurrence of
orthogonal polynomials, one CTE for each degree."""

from __future__ import annotations

from sparktrail.plans import oracle as O
from sparktrail.plans import registry as R


def fit_sql(name: str, points: str, deg: int) -> str:
    """CTEs that fit the lists x and y of ``points`` (web_id, x, y), ending in ``name`` (web_id, lo, hi, a, b, c)."""
    scaled = "CASE WHEN hi > lo THEN (v - lo) * 2.0 / (hi - lo) - 1.0 ELSE 0.0 END"
    sql = [f"""{name}_s AS (SELECT web_id, lo, hi, d, y, list_transform(x, lambda v: {scaled}) AS x FROM (
      SELECT *, list_min(x) AS lo, list_max(x) AS hi, LEAST({deg}, len(list_distinct(x)) - 1) AS d FROM {points})),
    {name}_0 AS (SELECT *, list_transform(x, lambda v: 1.0::DOUBLE) AS p, list_transform(x, lambda v: 0.0::DOUBLE) AS q,
      0.0::DOUBLE AS norm, []::DOUBLE[] AS a, []::DOUBLE[] AS b, []::DOUBLE[] AS c FROM {name}_s)"""]
    for k in range(deg + 1):
        dot = "list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1] * z[2]))"
        b = "n / norm" if k else "0.0::DOUBLE"
        sql.append(f"""{name}_f{k} AS (SELECT *, list_sum(list_transform(p, lambda v: v * v)) AS n,
          {dot.format('x', 'list_transform(p, lambda v: v * v)')} AS xpp, {dot.format('y', 'p')} AS yp FROM {name}_{k}),
        {name}_g{k} AS (SELECT *, xpp / n AS ak, {b} AS bk, yp / n AS ck FROM {name}_f{k}),
        {name}_{k + 1} AS (SELECT web_id, lo, hi, d, y, x,
          CASE WHEN {k} <= d THEN list_transform(list_zip(x, p, q), lambda z: (z[1] - ak) * z[2] - bk * z[3]) ELSE p END AS p,
          CASE WHEN {k} <= d THEN p ELSE q END AS q, CASE WHEN {k} <= d THEN n ELSE norm END AS norm,
          CASE WHEN {k} <= d THEN list_append(a, ak) ELSE a END AS a, CASE WHEN {k} <= d THEN list_append(b, bk) ELSE b END AS b,
          CASE WHEN {k} <= d THEN list_append(c, ck) ELSE c END AS c FROM {name}_g{k})""")
    sql.append(f"{name} AS (SELECT web_id, lo, hi, a, b, c FROM {name}_{deg + 1} WHERE len(x) > 0)")
    return ",\n".join(sql)


def value_sql(name: str, source: str, deg: int, at: str) -> str:
    """CTEs that add ``value``, the fit's value at ``at``, to ``source`` (which has lo, hi, a, b, c)."""
    sql = [f"""{name}_0 AS (SELECT *, CASE WHEN hi > lo THEN ({at} - lo) * 2.0 / (hi - lo) - 1.0 ELSE 0.0 END AS t,
      1.0::DOUBLE AS cur, 0.0::DOUBLE AS prev, 0.0::DOUBLE AS value FROM {source})"""]
    for k in range(deg + 1):
        on = f"{k + 1} <= len(c)"
        sql.append(f"""{name}_{k + 1} AS (SELECT * REPLACE (
          CASE WHEN {on} THEN (t - a[{k + 1}]) * cur - b[{k + 1}] * prev ELSE cur END AS cur,
          CASE WHEN {on} THEN cur ELSE prev END AS prev, CASE WHEN {on} THEN value + c[{k + 1}] * cur ELSE value END AS value)
          FROM {name}_{k})""")
    sql.append(f"{name} AS (SELECT * FROM {name}_{deg + 1})")
    return ",\n".join(sql)


def lot_sql(seed: int, keys=("uuid", "session_id")) -> str:
    text = " || '|' || ".join([*(f"COALESCE(CAST({k} AS VARCHAR), '')" for k in keys), f"'{seed}'"])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % 10000"


R.ORACLE["train_test_split"] = (R._FEAT_P + f"\nSELECT *, CASE WHEN {lot_sql(25)} < 3000 THEN 1 ELSE 0 END AS is_test FROM sf")

_POINTS = """pts AS (SELECT web_id, list(cum ORDER BY bin) AS x, list("left" ORDER BY bin) AS y FROM cu GROUP BY web_id)"""
_BUDGETS = f"""bud AS (SELECT id, web_id, CAST(coupon_total - coupon_used AS DOUBLE) / (1 + date_diff('day', {R._ASOF}, end_time)) AS avg_n_coupon
  FROM campaigns WHERE date_diff('day', {R._ASOF}, start_time) <= 2 AND {R._ASOF} <= end_time AND activity_enable = 1
  AND coupon_enable = 1 AND activity_delete = 0)"""
_CURVE = ", ".join([R._hist_sql("sc", "prob", 100, "web_id"), """
cu AS (SELECT * FROM (SELECT h.web_id, h.bin, h."left", CAST(SUM(count) OVER (PARTITION BY h.web_id)
    - SUM(count) OVER (PARTITION BY h.web_id ORDER BY h.bin) AS DOUBLE) / s.n_day_testing AS cum
  FROM hist h JOIN settings s ON s.web_id = h.web_id) WHERE "left" > 0.06)""", _POINTS, fit_sql("ft", "pts", 10), _BUDGETS, """
tg AS (SELECT bud.id, bud.web_id, bud.avg_n_coupon, CAST(s.n_day_testing AS DOUBLE) AS n_day, pts.x[1] AS max_n_coupon,
    1.0 / (1.0 + exp(-s.model_intercept)) AS lim, GREATEST(LEAST(bud.avg_n_coupon * s.n_weight, pts.x[1]), pts.x[len(pts.x)]) AS at,
    ft.lo, ft.hi, ft.a, ft.b, ft.c
  FROM bud JOIN settings s ON s.web_id = bud.web_id LEFT JOIN pts ON pts.web_id = bud.web_id LEFT JOIN ft ON ft.web_id = bud.web_id)""",
                    value_sql("va", "tg", 10, '"at"'), """
lb AS (SELECT id, web_id, avg_n_coupon, n_day, max_n_coupon, CASE WHEN c IS NULL THEN NULL
    WHEN value <= lim THEN lim * 1.1 ELSE value END AS lower_bound FROM va)"""])
R.ORACLE["fitted_curve_bound"] = R._FEAT_P + ", " + _CURVE + "\nSELECT id, web_id, max_n_coupon, lower_bound FROM lb"
R.ORACLE["bound_by_fit"] = R._FEAT_P + ", " + _CURVE + """,
pr AS (SELECT lb.id, COUNT(sc.uuid) AS pp, SUM(CASE WHEN sc.is_purchased = 1 THEN 1 ELSE 0 END) AS tp
       FROM lb LEFT JOIN sc ON sc.web_id = lb.web_id AND sc.prob BETWEEN lb.lower_bound AND 1.0 GROUP BY lb.id)
SELECT lb.id, lb.max_n_coupon, lb.avg_n_coupon, lb.lower_bound, CAST(floor(COALESCE(pr.pp, 0) / lb.n_day) AS BIGINT) AS estimated_n_coupon,
  CAST(COALESCE(pr.tp, 0) AS DOUBLE) / (CAST(COALESCE(pr.pp, 0) AS DOUBLE) + 0.1) AS model_precision
FROM lb LEFT JOIN pr ON pr.id = lb.id"""

R.ORACLE["upper_bound"] = R._FEAT_P + ", " + ", ".join([f"""
ts AS (SELECT sc.web_id, sc.prob FROM sc JOIN settings s ON s.web_id = sc.web_id
  WHERE {lot_sql(25, ('sc.uuid', 'sc.session_id'))} < 3000 AND sc.prob > s.lower_bound)""",
                                                       R._hist_sql("ts", "prob", 50, "web_id"), """
cu AS (SELECT h.web_id, h.bin, h."left", CAST(SUM(count) OVER (PARTITION BY h.web_id ORDER BY h.bin) AS DOUBLE)
    / s.test_size / s.n_day_testing AS cum FROM hist h JOIN settings s ON s.web_id = h.web_id)""", _POINTS,
                                                       fit_sql("ft", "pts", 4), """
tg AS (SELECT pts.web_id, LEAST(GREATEST(50.0 * s.n_weight, pts.x[1]), pts.x[len(pts.x)]) AS at, ft.* EXCLUDE (web_id)
  FROM pts JOIN settings s ON s.web_id = pts.web_id JOIN ft ON ft.web_id = pts.web_id)""",
                                                       value_sql("va", "tg", 4, '"at"')]) + """
SELECT web_id, LEAST(GREATEST(value, 0.0), 1.0) AS upper_bound FROM va"""
