"""Sharding by sampled splitters.

Records are ordered by a 64-bit hash of their text, so equal texts stand
together.  A size-weighted sample of the keys is drawn (a record is taken with a
probability in proportion to its bytes, by a hash, so that the sample is the
same each time), and the sample's quantiles are the boundaries of many fine
ranges.  The exact bytes of each range are summed; a range that came out too
large, as one with a big group of equal texts does, is subdivided by record.
Consecutive ranges then make up the shards: a range goes to the shard in which
the middle of its bytes falls, so the shards' sizes differ by about one range.
A record's slot is its place in its range plus the records of earlier ranges of
the shard.

The law is ``bytes``: sizes near equal.  Only DataFrame functions are used.

Scale: the text is read once, for its size, checksum and hash; all else works on
these.  The sample (about ``sample`` rows), the boundaries and the ranges (at
most twice ``shards * fine``) are bounded by parameters, which bounds the
broadcasts and the two windows over them; the window of the slots works on one
range at a time.  With more data, raise ``fine``.

Edge cases: a null text has no bytes and the checksum of the empty text; null
ids are shared out like others; repeated rows each have a slot of their own; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, stored

SHARDS = 40
#: Fine ranges for each shard, and sampled keys for each fine range.
FINE, SAMPLED = 128, 8
#: A range of more than so many times the mean bytes is subdivided.
OVERFULL = 1.5
_BIN_BITS = 12  # a key's bin is its highest bits


def _boundaries(keys: DataFrame, ranges: int, total: int) -> DataFrame:
    """(range, low, high): the sample's quantiles; the first low and the last high are null."""
    chance = F.col("size") * F.lit(float(ranges * SAMPLED) / max(total, 1))
    lot = F.pmod(F.xxhash64("key", "id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    sample = keys.where(lot < chance).select("key")
    in_order = Window.orderBy("key")
    placed = sample.select("key", F.row_number().over(in_order).alias("i"),
                           F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    cut = F.floor(F.col("i") * ranges / F.col("n"))
    cuts = placed.where(cut > F.floor((F.col("i") - 1) * ranges / F.col("n"))).select("key").distinct()
    edges = cuts.select(F.col("key").alias("low")).union(
        cuts.sparkSession.range(1).select(F.lit(None).cast("long").alias("low")))
    by_low = Window.orderBy(F.col("low").asc_nulls_first())
    return edges.select((F.row_number().over(by_low) - 1).alias("range"), "low", F.lead("low").over(by_low).alias("high"))


def _in_ranges(keys: DataFrame, ranges: DataFrame) -> DataFrame:
    """``keys`` with the number of their range: a join on the key's bin, then on the range's ends."""
    bins = F.sequence(F.coalesce(F.shiftright("low", 64 - _BIN_BITS), F.lit(-(1 << _BIN_BITS - 1))),
                      F.coalesce(F.shiftright("high", 64 - _BIN_BITS), F.lit((1 << _BIN_BITS - 1) - 1)))
    by_bin = ranges.select("range", "low", "high", F.explode(bins).alias("bin"))  # bins + ranges rows at most
    rows = keys.withColumn("bin", F.shiftright("key", 64 - _BIN_BITS))
    inside = (F.col("low").isNull() | (F.col("key") >= F.col("low"))) & (
        F.col("high").isNull() | (F.col("key") < F.col("high")))
    return rows.join(F.broadcast(by_bin), "bin").where(inside).drop("bin", "low", "high")


def shard_by_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                   fine: int = FINE) -> DataFrame:
    """One row per row of ``df``: the id, size, text_crc32, law, shard, slot and grown_shard (null under this law)."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = df.select(col(id_col).alias("id"), text.alias("t"))
    keys = stored(rows.select("id", (F.octet_length("t") + 16).cast("long").alias("size"),
                              F.crc32(F.col("t").cast("binary")).alias("crc"), F.xxhash64("t").alias("key"),
                              F.monotonically_increasing_id().alias("place")), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = shards * fine
    bounds = stored(_boundaries(keys, ranges, total), "ranges")
    placed = _in_ranges(keys, bounds)
    mean = max(total / ranges, 1.0)
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"))
    pieces = stored(sums.select("range", F.when(F.col("bytes") > OVERFULL * mean, F.ceil(F.col("bytes") / mean))
                                .otherwise(1).alias("pieces")), "pieces")
    piece = F.pmod(F.xxhash64("place", F.lit(23)), F.col("pieces")).cast("int")
    dealt = placed.join(F.broadcast(pieces), "range").withColumn("piece", piece)
    sizes = dealt.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range", "piece").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("bytes").over(before), F.lit(0)) + F.col("bytes") / 2
    shard = F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int")
    spread = sizes.select("range", "piece", "n", shard.alias("shard"))
    earlier = Window.partitionBy("shard").orderBy("range", "piece").rowsBetween(Window.unboundedPreceding, -1)
    spread = stored(spread.select("range", "piece", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                                  .alias("offset")), "spread")
    own = Window.partitionBy("range", "piece").orderBy("key", "id", "place")
    slots = dealt.select("*", (F.row_number().over(own) - 1).alias("i")).join(F.broadcast(spread), ["range", "piece"])
    return slots.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                        "shard", (F.col("offset") + F.col("i")).cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> None:
    """Write whole rows as one folder for each shard, in slot order inside each file."""
    keyed = stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    where = shard_by_bytes(keyed, "_row", text_col, shards).select("_row", "shard", "slot")
    out = keyed.join(where, "_row").drop("_row")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
