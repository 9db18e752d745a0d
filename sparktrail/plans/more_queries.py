"""Queries of operators' further options: tenant and campaign selections, the
roll-up of the stored daily table, code and row changes, mixture densities."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from sparktrail.operators import attribution as ATT
from sparktrail.operators import campaigns as CAMP
from sparktrail.operators import coupons as CPN
from sparktrail.operators import describe as DES
from sparktrail.operators import upsert as UP
from sparktrail.plans import adapters as A
from sparktrail.plans import oracle as O
from sparktrail.plans import registry as R
from sparktrail.plans.context import Tables
from sparktrail.plans.registry import register
from sparktrail.session import scratch_path

_KINDS = {"analysis": "enable_analysis = 1", "addfan": "enable_addfan = 1", "platform91": "platform = '91'",
          "no_model": "model_value IS NULL OR model_value = '_'"}


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("tenant_selections", R._D + " " + " UNION ALL ".join(
    f"SELECT '{k}' AS kind, web_id FROM settings WHERE {cond}" for k, cond in _KINDS.items()))
def q_tenant_selections(spark, sf_dir):
    """tenants by each of the four selections."""
    settings = A.supplier_settings(spark, sf_dir)
    return _union([CAMP.tenant_selection(settings, k).select(F.lit(k).alias("kind"), "web_id") for k in _KINDS])


_LIVE = "c.activity_enable = 1 AND c.ad_enable = 1 AND c.activity_delete = 0"


@register("campaigns_ads", R._D + f"""
SELECT 'running' AS mode, a.id, a.web_id, a.ad_url FROM act a JOIN campaigns c ON c.id = a.id
WHERE {R._ASOF} BETWEEN c.start_time AND c.end_time AND {_LIVE} UNION ALL
SELECT 'just_expired', a.id, a.web_id, a.ad_url FROM act a JOIN campaigns c ON c.id = a.id
WHERE CAST(c.update_time AS DATE) BETWEEN c.start_time AND c.end_time AND date_diff('day', c.end_time, {R._ASOF}) BETWEEN 0 AND 1
  AND {_LIVE} UNION ALL
SELECT 'by_id', id, web_id, ad_url FROM act WHERE id IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)""")
def q_campaigns_ads(spark, sf_dir):
    """campaigns with advertisements: running, just expired, and by id."""
    ids = A.read_table(spark, sf_dir, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("id"))
    return _union([R._part_activities(spark, sf_dir, mode, flag="ad_enable", **({"ids": ids} if mode == "by_id" else {}))
                   .select(F.lit(mode).alias("mode"), "id", "web_id", "ad_url") for mode in ("running", "just_expired", "by_id")])


@register("roas_rollup_by_id", "SELECT * FROM (" + R.ORACLE["roas_rollup"] + ") WHERE coupon_id IN (" + O.prefix()
          + "SELECT arg_max(coupon_id, (n, coupon_id)) FROM (SELECT web_id, coupon_id, COUNT(*) AS n FROM accept "
            "GROUP BY ALL) GROUP BY web_id)")
def q_roas_rollup_by_id(spark, sf_dir):
    """A10: roll-up of the stored daily table for a list of ids; an empty list gives no rows."""
    path = scratch_path(spark, f"daily-{uuid.uuid4().hex[:12]}")
    UP.write_table(R.QUERIES["roas_daily_mixed"](spark, sf_dir), path, ("date_time",))
    daily = spark.read.parquet(path)
    chosen = [r.id for r in R._most_accepted(Tables(spark, sf_dir)).select("id").collect()]  # a campaign per tenant
    return ATT.rollup_daily(daily, chosen).unionByName(ATT.rollup_daily(daily, []))


@register("coupon_mark_sent", "SELECT CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END AS is_sent, COUNT(*) AS n FROM (SELECT 'w' || "
          "CAST(user_id % 5 AS VARCHAR) AS web_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n FROM events "
          "WHERE event_type = 'view') GROUP BY ALL")
def q_coupon_mark_sent(spark, sf_dir):
    """The codes of a list marked as sent, all others not."""
    ev = A.base_events(spark, sf_dir).where("event_type = 'view'")
    codes = ev.select("web_id", F.lit("L").alias("link_code"), F.col("ord").cast("string").alias("coupon_code"),
                      F.lit(0).alias("is_sent"), "k")
    chosen = codes.where("k % 2 = 0").select("web_id", "link_code", "coupon_code")
    return CPN.mark_codes_sent(codes, chosen).groupBy("is_sent").agg(F.count(F.lit(1)).alias("n"))


@register("insert_rows", "SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL "
          "SELECT s_suppkey + 1000000000, s_name, NULL FROM supplier")
def q_insert_rows(spark, sf_dir):
    """K05 insert: rows of another table appended, a column that they lack null."""
    target = A.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows = A.read_table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000000000).alias("c_custkey"),
                                                          F.col("s_name").alias("c_name"))
    return UP.insert_rows(target, rows)


@register("fan_out", O.prefix() + f", tr AS ({R._TRACKER_SQL}) SELECT sink, COUNT(*) AS n_rows, CAST(SUM(n_events_load) AS BIGINT) "
          "AS n_loads FROM tr, (VALUES ('by_day'), ('by_tenant')) s(sink) GROUP BY sink")
def q_fan_out(spark, sf_dir):
    """Statistics computed once and written to two tables."""
    base = scratch_path(spark, f"fan-{uuid.uuid4().hex[:12]}")
    sinks = {"by_day": ("date",), "by_tenant": ("web_id",)}
    UP.fan_out(R.QUERIES["tracker_stats"](spark, sf_dir),
               [lambda df, k=k, by=by: UP.write_table(df, f"{base}/{k}", by) for k, by in sinks.items()])
    return _union([spark.read.parquet(f"{base}/{k}").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_events_load").alias("n_loads"))
                   .select(F.lit(k).alias("sink"), "n_rows", "n_loads") for k in sinks])


_GAUSS = [(0.6, 10.0, 4.0), (0.4, 60.0, 15.0)]
_EXP = [(0.7, 12.0), (0.3, 40.0)]
_JOINT = [(0.5, 10.0, 4.0, 8.0), (0.5, 60.0, 15.0, 20.0)]
_NORMAL = "(1.0 / {s} / sqrt(2 * pi())) * exp(-pow(value - {m}, 2) / (2 * {s} * {s}))"


def _mixture_sql() -> str:
    parts = []
    for i, (f, m, s) in enumerate(_GAUSS):
        parts.append(("ln_gauss", i, f"{math.log(f)} - ln({s}) - 0.5 * ln(2 * pi()) - pow(value - {m}, 2) / (2 * {s} * {s})"))
    for i, (f, tau) in enumerate(_EXP):
        parts += [("exp", i, f"{f} / {tau} * exp(-value / {tau})"), ("ln_exp", i, f"{math.log(f)} - ln({tau}) - value / {tau}"),
                  ("exp_survival", i, f"{f} * exp(-value / {tau})")]
    for i, (f, m, s, tau) in enumerate(_JOINT):
        parts.append(("joint", i, f"{f} * {_NORMAL.format(m=m, s=s)} / {tau} * exp(-t / {tau})"))
    src = "(SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS t FROM events)"
    return " UNION ALL ".join(f"SELECT '{kind}' AS kind, event_id, {i} AS component, {d} AS density FROM {src}" for kind, i, d in parts)


@register("mixture_forms", _mixture_sql())
def q_mixture_forms(spark, sf_dir):
    """Log, exponential, survival and joint forms of the mixture densities of event values."""
    ev = A.read_table(spark, sf_dir, "events").select("event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("t"))
    forms = {"ln_gauss": _GAUSS, "exp": _EXP, "ln_exp": _EXP, "exp_survival": _EXP}
    parts = [DES.mixture_density(ev, "value", comps, kind).withColumn("kind", F.lit(kind)) for kind, comps in forms.items()]
    parts.append(DES.joint_gauss_exp(ev, "value", "t", _JOINT).withColumn("kind", F.lit("joint")))
    return _union([p.select("kind", "event_id", "component", "density") for p in parts])
