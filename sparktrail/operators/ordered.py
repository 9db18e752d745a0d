"""Ordered computations without single-task windows (W01-W05, M07 support).

``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one
task; with one tenant or visitor holding a third of the rows that task
becomes the job. ``running_totals`` instead range-partitions by
(key, order) - Spark splits a hot key across many partitions - numbers and
sums rows inside each partition with an Arrow-batched pandas pass, and adds
the totals of earlier partitions of the same key from a small offsets table
(one row per key that crosses a partition boundary, broadcast).

Everything downstream (n-th largest, block averages, cumulative
histograms, ROC points) is then an equi-join or a bounded group-by on
(key, rank). Where equal values need no order among them, ``rank_table``
works on distinct values with their counts, so a million equal scores are
one row. Moving averages need no ranks: a partition's first rows are
mended from the last rows of those before it.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktrail.plans.sizing import maybe_broadcast


def _order_cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys are equal; ``keys`` come from the left."""
    on = F.lit(True)
    for k in keys:
        right = right.withColumnRenamed(k, f"_r_{k}")
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(df: DataFrame, part: list[str], order, sums: list[str] = (),
                   n_partitions: int | None = None, totals: bool = False) -> DataFrame:
    """Adds ``_rank`` (1-based row number within ``part`` in ``order``) and
    ``_cum_<c>`` (inclusive running sum of each column ``c`` in ``sums``).
    With ``totals`` also ``_n`` (rows) and ``_total_<c>`` of the whole key: they
    come with the offsets, by (key, partition), so no row is joined on its key.

    ``order`` must be a total order within a key (add a unique tie-breaker).
    """
    import pandas as pd

    part, sums = list(part), list(sums)
    oc = _order_cols(order)
    by = [*[F.col(p) for p in part], *oc]
    ranged = ((df.repartitionByRange(n_partitions, *by) if n_partitions else df.repartitionByRange(*by))
                .sortWithinPartitions(*[F.col(p) for p in part], *oc))
    out_schema = T.StructType(list(ranged.schema.fields) + [
        T.StructField("_pid", T.IntegerType()), T.StructField("_lrank", T.LongType())] + [
        T.StructField(f"_lcum_{c}", T.DoubleType()) for c in sums])

    def local(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        carry_key, carry_n, carry_s = None, 0, [0.0] * len(sums)
        for pdf in batches:
            if pdf.empty:
                continue
            new = pd.Series(False, index=pdf.index)
            for p in part:  # nulls are one key; None and "None" are two
                new |= (pdf[p] != pdf[p].shift()) & ~(pdf[p].isna() & pdf[p].shift().isna())
            new.iloc[0] = True
            grp = new.cumsum()
            first_grp = grp.iloc[0]
            cnt = grp.groupby(grp).cumcount() + 1
            key_at = lambda i: tuple(None if pd.isna(x) else x for x in pdf[part].iloc[i]) if part else ()
            same = (grp == first_grp) & (key_at(0) == carry_key)
            pdf = pdf.copy()
            pdf["_pid"] = pid
            pdf["_lrank"] = (cnt + same.astype("int64") * carry_n).astype("int64")
            for i, c in enumerate(sums):
                cs = pdf[c].astype("float64").fillna(0.0).groupby(grp.values).cumsum()
                pdf[f"_lcum_{c}"] = cs + same.astype("float64") * carry_s[i]
            last = grp == grp.iloc[-1]
            carry_key = key_at(-1)
            carry_n = int(pdf["_lrank"][last].iloc[-1])
            carry_s = [float(pdf[f"_lcum_{c}"][last].iloc[-1]) for c in sums]
            yield pdf

    # the numbered rows feed both the offsets and the result: materialise
    # once so the pandas pass runs a single time
    from sparktrail.plans.materialize import materialize
    loc = materialize(ranged.mapInPandas(local, out_schema))
    # per (key, partition) totals; only keys seen in several partitions need offsets
    tot = loc.groupBy(*part, "_pid").agg(F.max("_lrank").alias("_pn"),
                                         *[F.max(f"_lcum_{c}").alias(f"_ps_{c}") for c in sums])
    w = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.coalesce(F.sum("_pn").over(w), F.lit(0)).alias("_on"),
               *[F.coalesce(F.sum(f"_ps_{c}").over(w), F.lit(0.0)).alias(f"_os_{c}") for c in sums]]
    if totals:
        whole = Window.partitionBy(*part)
        off = tot.select(*part, "_pid", *offsets, F.sum("_pn").over(whole).alias("_n"),
                         *[F.sum(f"_ps_{c}").over(whole).alias(f"_total_{c}") for c in sums])
        off = maybe_broadcast(materialize(off))  # a row per key and partition: not bounded by the partitions
        r = null_safe_join(loc, off, [*part, "_pid"])
    else:
        multi = tot.groupBy(*part).agg(F.count(F.lit(1)).alias("_np")).where(F.col("_np") > 1).drop("_np")
        off = (null_safe_join(tot, multi, part) if part else tot).select(*part, "_pid", *offsets)
        r = null_safe_join(loc, F.broadcast(off), [*part, "_pid"], "left")  # two keys a partition at most
    r = r.withColumn("_rank", F.col("_lrank") + F.coalesce(F.col("_on"), F.lit(0)))
    for c in sums:
        r = r.withColumn(f"_cum_{c}", F.col(f"_lcum_{c}") + F.coalesce(F.col(f"_os_{c}"), F.lit(0.0)))
    return r.drop("_pid", "_lrank", "_on", *[f"_lcum_{c}" for c in sums], *[f"_os_{c}" for c in sums])


def rank_table(df: DataFrame, part: list[str], score: str) -> DataFrame:
    """The distinct scores of each key, descending: (part, score, n, upto, total): rows with this score, rows with this
    score or a larger one, and rows of the key. Ranks ``upto - n + 1`` to ``upto`` have this score."""
    counts = df.groupBy(*part, score).agg(F.count(F.lit(1)).alias("n"))
    run = running_totals(counts, part, [F.col(score).desc()], ["n"], totals=True)
    return run.select(*part, score, "n", F.col("_cum_n").cast("bigint").alias("upto"),
                      F.col("_total_n").cast("bigint").alias("total"))


def _power(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k)


def _blocks(lo: Column, hi: Column, levels: int) -> Column:
    """The range [lo, hi) as at most two blocks of 2^k numbers for each k: array<struct<_level, _block>>."""
    def at(k: Column) -> Column:
        size = _power(k)
        first, last = F.ceil(lo / size), F.floor(hi / size)
        left = F.when((first % 2 == 1) & (first < last), F.struct(k.alias("_level"), first.alias("_block")))
        right = F.when((last % 2 == 1) & (first + first % 2 < last), F.struct(k.alias("_level"), (last - 1).alias("_block")))
        return F.filter(F.array(left, right), lambda b: b.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def at_rank(table: DataFrame, wanted: DataFrame, part: list[str], score: str, rank: str) -> DataFrame:
    """``wanted`` (a key and a rank from 1) with the score at that rank of a ``rank_table``, null if it has none.

    A score's ranks are split into aligned blocks of powers of two, a wanted rank
    lies in one block of each size: an equi-join on (key, size, block), in which
    no key is hot, and a score with n rows has about 2 log n blocks."""
    levels = max(1, int(table.agg(F.max("upto")).first()[0] or 1).bit_length())
    ranges = table.select(*part, score, F.inline(_blocks(F.col("upto") - F.col("n"), F.col("upto"), levels)))
    place = F.col(rank) - 1
    points = wanted.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumn(
        "_block", F.floor(place / _power(F.col("_level"))))
    found = null_safe_join(points, ranges, [*part, "_level", "_block"]).select(*wanted.columns, score)
    missing = null_safe_join(wanted, found.select(*part, rank).distinct(), [*part, rank], "left_anti")
    return found.unionByName(missing.withColumn(score, F.lit(None).cast(table.schema[score].dataType)))


def nth_largest(df: DataFrame, part: list[str], score: str, tiebreak: list[str]) -> DataFrame:
    """Rank rows by ``score`` descending within ``part``; adds ``_rank``
    and ``_n`` (rows in the key)."""
    return running_totals(df, part, [F.col(score).desc(), *[F.col(t) for t in tiebreak]], totals=True)


def moving_average(df: DataFrame, part: list[str], order, value: str, m: int,
                   n_partitions: int | None = None) -> DataFrame:
    """Adds ``<value>_mavg``, the mean over rows max(0, i-m+1)..i of the key (partial start; nulls don't count).

    The rows are range-partitioned once and averaged within their partition by
    prefix sums. Only a partition's first m-1 rows of its first key lack rows:
    these are averaged again together with the last m-1 rows of the partitions
    (as many rows as partitions times m, however large the key)."""
    part = list(part)
    by = [*[F.col(p) for p in part], *_order_cols(order)]
    ranged = (df.repartitionByRange(n_partitions, *by) if n_partitions else df.repartitionByRange(*by))
    out = f"{value}_mavg"
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType()), T.StructField("_pid", T.IntegerType()),
                           T.StructField("_at", T.LongType()), T.StructField("_open", T.BooleanType()),
                           T.StructField("_tail", T.BooleanType())])
    from sparktrail.plans.materialize import materialize
    loc = materialize(ranged.sortWithinPartitions(*by).mapInPandas(partial(_trailing_means, part, value, m, out), schema))
    few = loc.where("_open OR _tail")
    back = Window.partitionBy(*part).orderBy("_pid", "_at").rowsBetween(-(m - 1), 0)
    mended = few.withColumn(out, F.avg(F.col(value).cast("double")).over(back)).where("_open")
    return loc.where("NOT _open").unionByName(mended).drop("_pid", "_at", "_open", "_tail")


def _trailing_means(part: list[str], value: str, m: int, out: str, batches):
    """One partition of ``moving_average``: the last m-1 rows are held back until they turn out to be its tail or not."""
    import numpy as np
    import pandas as pd
    from pyspark import TaskContext

    pid, at, first_key, kept = TaskContext.get().partitionId(), 0, True, None

    def new_keys(pdf):
        new = np.zeros(len(pdf), bool)
        for p in part:  # nulls are one key; None and "None" are two
            c = pdf[p]
            new |= ((c != c.shift()) & ~(c.isna() & c.shift().isna())).to_numpy()
        new[0] = True
        return new

    for pdf in batches:
        if pdf.empty:
            continue
        pdf = pdf.reset_index(drop=True)
        old = 0 if kept is None else len(kept)
        both = pdf if kept is None else pd.concat([kept[pdf.columns], pdf], ignore_index=True)
        starts = np.maximum.accumulate(np.where(new_keys(both), np.arange(len(both)), 0))
        i = np.arange(len(both))
        v = both[value].astype("float64").to_numpy()
        some = ~np.isnan(v)
        sums = np.concatenate([[0.0], np.cumsum(np.where(some, v, 0.0))])
        counts = np.concatenate([[0], np.cumsum(some)])
        lo = np.maximum(starts, i - m + 1)
        n = counts[i + 1] - counts[lo]
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(n > 0, (sums[i + 1] - sums[lo]) / n, np.nan)
        pdf[out] = pd.Series(mean[old:]).where(n[old:] > 0, None)
        pdf["_pid"], pdf["_at"] = pid, np.arange(at, at + len(pdf))
        in_first = (starts[old:] == 0) & first_key
        pdf["_open"] = in_first & (pdf["_at"].to_numpy() < m - 1)
        first_key, at = bool(in_first[-1]), at + len(pdf)
        pdf["_tail"] = False
        whole = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        cut = max(0, len(whole) - (m - 1))
        kept = whole.iloc[cut:].reset_index(drop=True)
        if cut:
            yield whole.iloc[:cut]
    if kept is not None and len(kept):
        kept["_tail"] = True
        yield kept


def block_average(df: DataFrame, part: list[str], order, value: str, m: int) -> DataFrame:
    """Mean of consecutive blocks of m rows; an incomplete tail block is
    dropped."""
    r = running_totals(df, part, order)
    return (r.groupBy(*part, F.floor((F.col("_rank") - 1) / m).alias("block"))
             .agg(F.avg(value).alias(f"{value}_bavg"), F.count(F.lit(1)).alias("_c"))
             .where(F.col("_c") == m).drop("_c"))


def last_non_null(df: DataFrame, keys: list[str], cols: list[str], order: list[str]) -> DataFrame:
    """Per key, the latest non-null value of each column by ``order``
    (partial-aggregated ``max_by``, no window)."""
    ordv = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), ordv)).alias(c) for c in cols])
