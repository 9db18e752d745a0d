"""Size-checked broadcast, and shuffles sized by their rows.

A dimension side is broadcast only after it is proven small, in rows and in
bytes; otherwise the plain DataFrame is returned and Spark plans a shuffle join
(AQE may still convert it at runtime from real shuffle statistics). Where the
optimizer knows the size of a table, no job is run for the proof.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktrail.session import configured

# Rows and bytes above which a dimension is never hinted for broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20
# A table estimated to be this small is taken as it is: compressed files grow by far less than the factor between both.
_SURE_BYTES = 4 << 20


# Rows of some hundred bytes that a task sorts in little memory.
ROWS_PER_TASK = 1 << 16
# Up to so many partitions Spark's shuffle writer keeps no rows in memory.
MOST_PARTITIONS = 200


def shuffled_for(spark: SparkSession, rows: int):
    """Within, shuffles begin with a partition for every ``ROWS_PER_TASK`` rows, where that is more than the session has;
    AQE joins small ones. So what a task holds doesn't grow with the input until there are ``MOST_PARTITIONS``."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = max(least, min(MOST_PARTITIONS, rows // ROWS_PER_TASK))
    return configured(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(first)} if first > least else {})


def bounded_size(df: DataFrame, limit: int) -> tuple[int, int]:
    """(rows, bytes as text) of ``df``, counted up to ``limit + 1`` rows."""
    width = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 8 for f in df.schema.fields]
    total = width[0]
    for w in width[1:]:
        total = total + w
    n, size = df.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(total.cast("long")), F.lit(0))).first()
    return n, size


def _estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate, for plans of scans, filters, projections, joins and aggregates; it doesn't see what a
    generator multiplies."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if "Generate" in plan.toString():
        return 1 << 62
    return int(plan.stats().sizeInBytes())


def is_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    if _estimated_bytes(df) <= min(_SURE_BYTES, max_bytes):
        return True
    n, size = bounded_size(df, max_rows)
    return n <= max_rows and size <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def broadcast_if_bounded(df: DataFrame, source: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                         max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` when it has at most one row per row of ``source`` (a
    dimension, e.g. the campaign table) and ``source`` is proven small. The
    check runs on the cheap source instead of executing ``df`` twice."""
    return F.broadcast(df) if is_small(source, max_rows, max_bytes) else df
