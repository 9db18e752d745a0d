"""Purchase-propensity feature sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktrail.operators.ordered import last_non_null
from sparktrail.plans.sizing import maybe_broadcast

ACTIONS = {"is_purchased": "purchase", "is_addCart": "addCart", "is_removeCart": "removeCart"}


def uuid_guard(df: DataFrame, length: int = 36) -> DataFrame:
    """keep visitors whose id text has exactly ``length`` characters."""
    return df.where(F.length(F.col("uuid").cast("string")) == length)


def _visitor_keys(load: DataFrame) -> list[str]:
    """A visitor is known by tenant and id; a table of one tenant may leave the tenant out."""
    return [c for c in ("web_id", "uuid") if c in load.columns]


def session_flags(load: DataFrame, actions: dict[str, DataFrame], match: str = "any_exact") -> DataFrame:
    """Flag load rows whose (web_id, uuid, session_id) also has the action.

    ``match='last_contains'`` reproduces the reference code literally: the
    action's latest session of the visitor must *contain* the load row's
    session id as a substring."""
    out, visitor = load, _visitor_keys(load)
    for flag, act in actions.items():
        if match == "any_exact":
            keys = act.select(*visitor, "session_id").distinct().withColumn(flag, F.lit(1))
            out = out.join(keys, [*visitor, "session_id"], "left")
        elif match == "last_contains":
            last = (act.groupBy(*visitor)
                       .agg(F.max_by("session_id", F.struct("timestamp", "ord")).alias(f"_{flag}_s")))
            out = (out.join(last, visitor, "left")
                      .withColumn(flag, F.when(F.instr(F.col(f"_{flag}_s").cast("string"),
                                                       F.col("session_id").cast("string")) > 0, 1))
                      .drop(f"_{flag}_s"))
        else:
            raise ValueError(match)
        out = out.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)).cast("int"))
    return out


def visitor_flags(load: DataFrame, actions: dict[str, DataFrame]) -> DataFrame:
    """Flag load rows whose visitor has the action at all."""
    out, visitor = load, _visitor_keys(load)
    for flag, act in actions.items():
        keys = act.select(*visitor).distinct().withColumn(flag, F.lit(1))
        out = out.join(keys, visitor, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)).cast("int"))
    return out


def collect_tenants(tables: dict[str, DataFrame], tenants: DataFrame,
                    roles=("load", "purchase", "addCart", "removeCart")) -> DataFrame:
    """Rows of ``roles`` of the listed tenants, with their role and their
    tenant's number of loads; a tenant without loads is passed over."""
    loads = tables["load"].groupBy("web_id").agg(F.count(F.lit(1)).alias("n_load"))
    chosen = maybe_broadcast(tenants.select("web_id").distinct().join(loads, "web_id"))
    rows = [tables[r].join(chosen, "web_id").withColumn("role", F.lit(r)) for r in roles]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def session_features(load, purchase, add_cart, remove_cart, keys: list[str], match: str = "any_exact") -> DataFrame:
    """One row per (web_id, uuid, session_id): the latest non-null value of each
    feature column (by timestamp, then ingest ordinal) and the three flags."""
    load, purchase, add_cart, remove_cart = (uuid_guard(d) for d in (load, purchase, add_cart, remove_cart))
    flagged = session_flags(load, {"is_purchased": purchase, "is_addCart": add_cart,
                                   "is_removeCart": remove_cart}, match)
    group = ["web_id", "uuid", "session_id"]
    cols = list(dict.fromkeys([c for c in keys if c not in group] + list(ACTIONS)))
    return last_non_null(flagged, group, cols, ["timestamp", "ord"])


def visitor_features(load, purchase, add_cart, remove_cart, keys: list[str]) -> DataFrame:
    """One row per tenant's visitor with ``landing_count > 0``: latest non-null
    values and visitor-level flags."""
    load, purchase, add_cart, remove_cart = (uuid_guard(d) for d in (load, purchase, add_cart, remove_cart))
    flagged = visitor_flags(load, {"is_purchased": purchase, "is_addCart": add_cart, "is_removeCart": remove_cart})
    group = ["web_id", "uuid"]
    cols = list(dict.fromkeys([c for c in keys if c not in group] + list(ACTIONS)))
    return last_non_null(flagged.where(F.col("landing_count") > 0), group, cols, ["timestamp", "ord"])


def visitor_max(sessions: DataFrame, group=("web_id", "uuid")) -> DataFrame:
    """Per tenant's visitor the max of every column; then mobile only
    (``device != 0``) and new buyers (``is_purchased_before = 0``)."""
    cols = [c for c in sessions.columns if c not in group]
    return (sessions.groupBy(*group).agg(*[F.max(c).alias(c) for c in cols])
                    .where((F.col("device") != 0) & (F.col("is_purchased_before") == 0)))
