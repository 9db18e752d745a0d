"""Table mutations as DataFrame transforms.

A metric or clean table is a DataFrame keyed by a unique key; an upsert
produces the new table version, which the caller writes back (partition
overwrite) - idempotent, so a re-run after a lost executor or a failed job
gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(updates: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the last by ``order``, the largest row where that ties (or isn't given)."""
    rest = [c for c in updates.columns if c not in keys]
    if not rest:
        return updates.distinct()
    row = F.struct(*[F.col(c) for c in rest])
    last = F.max_by(row, F.struct(*[F.col(c) for c in order or []], row)).alias("_row")
    return updates.groupBy(*keys).agg(last).select(*[c if c in keys else F.col("_row")[c].alias(c)
                                                     for c in updates.columns])


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], cols: list[str] | None = None,
           order: list[str] | None = None) -> DataFrame:
    """Insert new keys; on an existing key update only ``cols`` (all
    non-key update columns when None) - a NULL in the update is written, as
    ``ON DUPLICATE KEY UPDATE c = VALUES(c)`` does. Of several updates of one
    key the last by ``order`` counts."""
    updates = latest_by_key(updates, keys, order)
    cols = [c for c in (cols or [c for c in updates.columns if c not in keys])]
    t = target.withColumn("_in_t", F.lit(True))
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in updates.columns if c not in keys]) \
               .withColumn("_in_u", F.lit(True))
    j = t.join(u, keys, "full")
    out = []
    all_cols = list(dict.fromkeys([*target.columns, *[c for c in updates.columns if c not in target.columns]]))
    for c in all_cols:
        if c in keys:
            out.append(F.col(c))
            continue
        has_u = c in updates.columns
        has_t = c in target.columns
        tv = F.col(c) if has_t else F.lit(None)
        uv = F.col(f"_u_{c}") if has_u else F.lit(None)
        matched = F.col("_in_t").isNotNull() & F.col("_in_u").isNotNull()
        inserted = F.col("_in_t").isNull()
        if has_u and c in cols:
            v = F.when(matched | inserted, uv).otherwise(tv)
        elif has_u:
            v = F.when(inserted, uv).otherwise(tv)
        else:
            v = tv
        out.append(v.alias(c))
    return j.select(*out)


def replace_rows(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``REPLACE INTO``: rows of ``updates`` replace whole rows by key."""
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates, allowMissingColumns=True)


def update_rows(target: DataFrame, updates: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Update ``cols`` of matched rows only; never inserts."""
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols]).withColumn("_m", F.lit(True))
    j = target.join(u, keys, "left")
    return j.select(*[F.when(F.col("_m").isNotNull(), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
                      if c in cols else F.col(c) for c in target.columns])


def delete_rows(target: DataFrame, condition) -> DataFrame:
    """K05 delete by statement: the table without matching rows (a row whose
    condition is NULL doesn't match and stays)."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def insert_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """K05 insert."""
    return target.unionByName(rows, allowMissingColumns=True)


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """Write a table version; with ``partition_by`` only touched partitions
    are replaced (dynamic partition overwrite)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 100_000,
               properties: dict | None = None) -> None:
    """Load into a relational table: every Spark partition writes its
    rows in ``batchsize`` batches (the reference's 100 000-row chunks)."""
    df.write.mode(mode).option("batchsize", batchsize).jdbc(url, table, properties=properties or {})


def fan_out(df: DataFrame, sinks: list) -> None:
    """Compute once, write to several sinks (callables taking the
    DataFrame)."""
    df = df.persist()
    try:
        for sink in sinks:
            sink(df)
    finally:
        df.unpersist()
