"""A Merkle manifest of a dataset: digests of rows, trees of digests by group, one root, and proofs of rows.

A row's leaf is the digest of its fields, each with its length before it.  The
leaves of a group (``lang``) ascend by id; every 8 consecutive nodes become the
digest of their digests, level by level, until one is left, the group's subroot.
The subroots, in the order of the groups (null first, then by UTF-8 bytes), make
up the root in the same way.

The manifest is a store of records from a digest to its children's digests, one
table for each height.  A proof is found by descent from the root: a leaf's rank
in its group, written in base 8, names the child to take in each record; the
children not taken are its proof's segment of that height.  Requests that share
a prefix of their digits go down together as one row, so a height moves as many
rows as it has nodes asked for, at most an eighth of the height below, and no
record is joined with more than one row for each node.  Only the last step
gives a row per request.  The segments, found from the top down, are turned
round, as a proof is checked from the leaf up.  The way down is a chain of joins
in which each step is read once; it is written at every second height only, which
keeps the plans small.

Ranks come from one range partitioning: a row's position is its place in its
partition plus the rows of the partitions before, and its rank is its position
less its group's first.  No window holds more than a row per partition.

Edge cases: null and empty fields have leaves of their own kind (``-`` and
``0:``); a null id comes first in its group; equal ids stand in the order of
their leaves, and repeated rows each have a place of their own; a group of one
row is its own subroot, a dataset of one group has its subroot for a root, and
the proof of a dataset of one row is the digest of nothing; an empty table has
no root, and gives no rows.  Columns that aren't named fields are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, as a power of two.
_BITS = 3
ARITY = 1 << _BITS
_SEGMENTS = "array<struct<left:string,right:string>>"
#: Nodes of a height for which a file is worth its while: about 1.3 MB of records.
_FILE_NODES = 2048


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(value, 256)


def row_digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row: each field as ``-`` if null, else its UTF-8 length, ``:`` and the value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def positions(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``pos``, its rows' place in ``order`` from 0; ties in any order."""
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(parts), "_part")
            .withColumn("pos", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_at", "_part", "_before"))


@dataclass
class Manifest:
    """``rows``: the leaves with group number ``g`` and ``rank``; ``groups``: g, group, height; ``trees`` and ``top``:
    the store's records (digest, children) by height from 1, of the groups' trees and of the tree over subroots;
    ``size`` and ``many``: how many rows and groups there are."""

    rows: DataFrame
    groups: DataFrame
    trees: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    size: int
    many: int


def _height(n: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _in_files(nodes: DataFrame, size: int, trees: int, height: int) -> DataFrame:
    """``nodes`` of a height over ``size`` leaves of so many ``trees``, in as few partitions as their number is worth."""
    return nodes.coalesce(-(-(size // ARITY ** height + trees) // _FILE_NODES))


def _risen(nodes: DataFrame, size: int, trees: int, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The records of each height over ``nodes`` (g, idx, digest, n: nodes of the tree at this height; ``size`` in all,
    in so many ``trees``), and the last node of each tree."""
    records, done = [], nodes.where("n = 1").select("g", "digest")
    for height in range(1, levels + 1):
        run = F.sort_array(F.collect_list(F.struct("idx", "digest")))  # 8 at most
        nodes = (nodes.where("n > 1").groupBy("g", F.shiftright("idx", _BITS).alias("idx"))
                 .agg(F.transform(run, lambda x: x["digest"]).alias("children"), F.max("n").alias("n"))
                 .select("g", "idx", digest(F.array_join("children", "")).alias("digest"), "children",
                         F.ceil(F.col("n") / ARITY).alias("n")))
        nodes = stored(_in_files(nodes, size, trees, height), f"{name}{height}")
        records.append(nodes.select("digest", "children"))
        done = done.union(nodes.where("n = 1").select("g", "digest"))
    return records, done


def manifest(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves`` (id, group, leaf; further columns are carried along)."""
    leaves = stored(leaves.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    rows = positions(leaves, F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"),
                     F.col("_tie")).drop("_tie")
    spans = rows.groupBy("group").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    spans = stored(positions(spans, F.col("first")).withColumnRenamed("pos", "g"), "groups")
    how_many, widest, size = spans.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    same = F.col("group").eqNullSafe(F.col("of"))
    rows = rows.join(spans.withColumnRenamed("group", "of"), same).withColumn("rank", F.col("pos") - F.col("first"))
    rows = stored(rows.drop("of", "first", "pos"), "ranked")
    nodes = rows.select("g", F.col("rank").alias("idx"), F.col("leaf").alias("digest"), "n")
    trees, subroots = _risen(nodes, size or 0, how_many, _height(widest or 0), "tree")
    ordered = subroots.select(F.lit(0).alias("g"), F.col("g").alias("idx"), "digest", F.lit(how_many).alias("n"))
    top, last = _risen(stored(ordered, "subroots"), how_many, 1, _height(how_many), "top")
    root = last.first()
    n, height = F.col("n"), F.lit(0)
    for _ in trees:
        height, n = height + (n > 1).cast("int"), F.when(n > 1, F.ceil(n / ARITY)).otherwise(n)
    groups = spans.select("g", "group", height.alias("height"))
    return Manifest(rows.drop("n"), groups, trees, top, root["digest"] if root else None, size or 0, how_many)


def _wanted(asked: DataFrame, up: int) -> DataFrame:
    """The digits (child numbers, as bits) by which nodes ``up`` heights above those asked for lead to them: g, idx,
    digits."""
    digit = F.shiftright("idx", _BITS * (up - 1)).bitwiseAND(F.lit(ARITY - 1)).cast("int")
    return (asked.groupBy("g", F.shiftright("idx", _BITS * up).alias("idx"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), digit)).alias("digits")))


def _down(nodes: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """From nodes (g, idx, digest, path, ...) to those of their children that are wanted, paths longer by the others."""
    known = records.groupBy("digest").agg(F.first("children").alias("children"))  # equal subtrees have one record
    met = nodes.join(wanted, ["g", "idx"]).join(known, "digest")
    bits = [F.when(F.col("digits").bitwiseAND(F.lit(1 << i)) != 0, i) for i in range(ARITY)]
    digits = F.explode(F.array_compact(F.array(*bits))).alias("digit")
    each = met.select(*[c for c in met.columns if c not in ("digits", "digest")], digits)
    return each.withColumn("path", _longer()).select(
        "g", (F.shiftleft("idx", _BITS) + F.col("digit")).alias("idx"), _taken().alias("digest"), "path",
        *[c for c in nodes.columns if c not in ("g", "idx", "digest", "path")])


def _taken() -> Column:
    return F.element_at("children", F.col("digit") + 1)


def _longer() -> Column:
    left = F.array_join(F.slice("children", F.lit(1), F.col("digit")), "")
    right = F.array_join(F.slice("children", F.col("digit") + 2, F.lit(ARITY)), "")
    return F.concat("path", F.array(F.struct(left.alias("left"), right.alias("right"))))


def proofs(m: Manifest, requests: DataFrame) -> DataFrame:
    """For each row of ``requests`` (g, rank and columns to carry): those, ``found`` (the leaf that the store gives),
    ``subroot`` and ``path``, the siblings of each height from the leaf up as hex digests (left, right).

    ``requests`` names a leaf once, so that a run has 8 at most."""
    spark = requests.sparkSession
    carried = [c for c in requests.columns if c not in ("g", "rank")]
    if m.root is None:
        return requests.select("g", "rank", *carried, F.lit("").alias("found"), F.lit("").alias("subroot"),
                               F.array().cast(_SEGMENTS).alias("path")).limit(0)
    runs = requests.select("g", F.shiftright("rank", _BITS).alias("idx")).distinct()
    asked = stored(_in_files(runs, m.size, m.many, 1), "asked")
    at = stored(spark.range(1).select(F.lit(0).alias("g"), F.lit(0).cast("long").alias("idx"), F.lit(m.root).alias("digest"),
                                      F.array().cast(_SEGMENTS).alias("path")), "root")
    of_groups = asked.select(F.lit(0).alias("g"), F.col("g").alias("idx")).distinct()
    for height in range(len(m.top), 0, -1):
        at = _down(at, m.top[height - 1], _wanted(of_groups, height))
    trees = at.select(F.col("idx").alias("g"), F.lit(0).cast("long").alias("idx"), "digest", "path",
                      F.col("digest").alias("subroot"))
    entering = stored(trees.join(m.groups.select("g", "height"), "g"), "entering")
    at = None
    for height in range(len(m.trees), 0, -1):
        new = entering.where(F.col("height") == height).drop("height")
        at = new if at is None else at.unionByName(new)
        if height > 1:
            at = _down(at, m.trees[height - 1], _wanted(asked, height - 1))
            if height % 2:
                at = stored(_in_files(at, m.size, m.many, height - 1), "below")
    row = F.struct("rank", *carried)
    lone = entering.where("height = 0").drop("height").join(requests, "g").select(
        "g", row.alias("ask"), F.col("digest").alias("found"), "subroot", "path")
    if at is not None:
        runs = requests.groupBy("g", F.shiftright("rank", _BITS).alias("idx")).agg(F.collect_list(row).alias("asks"))
        known = m.trees[0].groupBy("digest").agg(F.first("children").alias("children"))
        met = at.join(known, "digest").join(runs, ["g", "idx"])
        each = met.select("g", "subroot", "path", "children", F.explode("asks").alias("ask"))
        each = each.withColumn("digit", F.col("ask.rank").bitwiseAND(F.lit(ARITY - 1)).cast("int"))
        lone = each.select("g", "ask", _taken().alias("found"), "subroot", _longer().alias("path")).unionByName(lone)
    return lone.select("g", "ask.rank", *[F.col("ask")[c].alias(c) for c in carried], "found", "subroot",
                       F.reverse("path").alias("path"))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, height by height from the leaf up, each from left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda now, s: digest(F.concat(s["left"], now, s["right"])))


def merkle_proofs(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
                  claims: dict[str, Column] | None = None) -> DataFrame:
    """A row for each row of ``df``: the id, leaf, subroot, root, proof_sha256, folded_root and verified.

    The manifest is of the rows as they are; ``claims`` gives fields other values
    in the rows that are checked against it (by default none, so all are verified)."""
    claims = claims or {}
    leaves = df.select(col(id_col).alias("id"), col(group_col).cast("string").alias("group"),
                       row_digest([col(c) for c in fields]).alias("leaf"),
                       row_digest([claims.get(c, col(c)) for c in fields]).alias("claim"))
    m = manifest(leaves)
    found = proofs(m, m.rows.select("g", "rank", "id", "claim"))
    root = F.lit(m.root)
    return (found.withColumn("folded_root", folded(F.col("claim"), F.col("path")))
            .select(F.col("id").alias(id_col), F.col("found").alias("leaf"), "subroot", root.cast("string").alias("root"),
                    proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == root).alias("verified")))
