"""Order-level aggregates: order totals (A03/A04), order revenue with the
reference's line-order rule (A13), session revenue (A14) and tenant price
averages (A22)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_KEY = ["web_id", "uuid", "session_id", "timestamp"]


def order_totals(purchase: DataFrame, min_total=None, key=ORDER_KEY) -> DataFrame:
    """``SUM(price * qty)`` and ``AVG(ABS(coupon))`` per order, optional
    strict ``HAVING total > min_total``."""
    from sparktrail.functions.scalars import coupon_number
    o = purchase.groupBy(*key).agg(
        F.sum(F.col("product_price") * F.col("product_quantity")).alias("total"),
        F.avg(F.abs(coupon_number(F.col("coupon")))).alias("coupon_avg"),
        F.min("ord").alias("ord"))
    return o if min_total is None else o.where(F.col("total") > F.lit(min_total))


def first_order_per_session(orders: DataFrame, group=("web_id", "uuid", "session_id")) -> DataFrame:
    """One order per session - the earliest (timestamp, ord), so all
    picked values come from the same order."""
    return orders.groupBy(*group).agg(
        F.min_by(F.struct(*[c for c in orders.columns if c not in group]),
                 F.struct("timestamp", "ord")).alias("o")).select(*group, "o.*")


def order_revenue(purchase: DataFrame, key=ORDER_KEY, ordinal: str = "ord") -> DataFrame:
    """Revenue per order, order-sensitive as in the reference loop: a
    line with ``total_price > 0`` sets the order value, a line without adds
    ``price * qty`` (price -1 -> 0, quantity floored at 0).

    Result = total of the last positive-total line + the line values after
    it (all line values when there is none). The lines are joined with their
    order's last positive line and summed on the same key, so no window
    partition buffers a hot order, and the lines are read twice.
    """
    line = purchase.select(
        *key, F.col(ordinal).alias("_ord"),
        F.greatest(F.col("total_price"), F.lit(0)).alias("_tot"),
        (F.when(F.col("product_price") == -1, F.lit(0)).otherwise(F.col("product_price"))
         * F.greatest(F.col("product_quantity"), F.lit(0))).alias("_val"))
    # max of (ordinal, total) over positive lines: ties on the ordinal keep
    # the larger total, so the pick is deterministic
    last = (line.groupBy(*key)
                .agg(F.max(F.when(F.col("_tot") > 0, F.struct("_ord", "_tot"))).alias("_lp"))
                .select(*key, F.col("_lp._ord").alias("_last"), F.col("_lp._tot").alias("_set")))
    after = F.col("_last").isNull() | (F.col("_ord") > F.col("_last"))
    return (last.join(line.select(*key, "_ord", "_val"), list(key), "left")
                .groupBy(*key).agg(F.max("_set").alias("_set"), F.sum(F.when(after, F.col("_val"))).alias("_add"))
                .select(*key, (F.coalesce(F.col("_set"), F.lit(0)) + F.coalesce(F.col("_add"), F.lit(0))).alias("revenue")))


def session_revenue(order_rev: DataFrame, key=("web_id", "uuid", "session_id")) -> DataFrame:
    """Sum of order revenue per session."""
    return order_rev.groupBy(*key).agg(F.sum("revenue").alias("revenue"))


def price_averages(purchase: DataFrame) -> DataFrame:
    """Per tenant ``avg(shipping_price != 0)`` and average order value
    (``sum(total)/count(total)`` over order groups); missing -> -1;
    truncated to int."""
    ship = (purchase.where(F.col("shipping_price") != 0).groupBy("web_id")
                    .agg(F.avg("shipping_price").alias("_ship")))
    orders = purchase.groupBy("web_id", "uuid", "session_id", "timestamp").agg(
        F.sum(F.col("product_price") * F.col("product_quantity")).alias("total"))
    aov = orders.groupBy("web_id").agg((F.sum("total") / F.count("total")).alias("_aov"))
    tenants = purchase.select("web_id").distinct()
    return (tenants.join(ship, "web_id", "left").join(aov, "web_id", "left")
            .select("web_id",
                    F.coalesce(F.col("_ship").cast("double"), F.lit(-1.0)).cast("bigint").alias("avg_shipping_price"),
                    F.coalesce(F.col("_aov").cast("double"), F.lit(-1.0)).cast("bigint").alias("avg_total_price")))
