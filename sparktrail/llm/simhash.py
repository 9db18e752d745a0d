"""SimHash near-duplicates by a segment-popcount embedding.

Every text gets a 64-bit SimHash over its word shingles.  Fingerprints that
differ in at most ``max_bits`` bits are linked, and a document's class is its
connected component.

Candidates come from an embedding: the fingerprint is cut into 32 segments of
two bits, and each segment is mapped to its number of set bits.  The Manhattan
distance of two such vectors never exceeds their Hamming distance.  If it is at
most ``max_bits``, so many segments differ at most.  The segments are dealt to
``groups`` groups, of which then all but ``max_bits`` are equal: both
fingerprints lie in the grid cell that is named by those groups and their counts.
Every fingerprint is put into one cell for each choice of groups, the rows of a
cell are compared (Manhattan distance first, then the exact number of differing
bits), and each cell gives a spanning star of every class it sees, never all of
its pairs.

The counts are kept in unary (0, 1, 2 as 00, 01, 11), so that the Manhattan
distance is the number of set bits of an exclusive or.

Scale: equal fingerprints are one row from the start, so a group of exact
copies costs one row however large it is.  More groups make more cells, and each
of them smaller: ``grid_groups`` takes as many as the number of distinct
fingerprints needs for about ``PARTNERS`` chance partners in a cell (6 groups and
20 cells for 3 bits and up to 4e8 fingerprints; 8 groups and 56 cells for 2e10).
The links found are the same for any number.  A cell of more than ``cell_rows``
rows is dealt out as blocks of two chunks each, every pair of chunks to one
block, so that no task holds a whole cell.  Nothing is dropped: all pairs of
chunks meet.

Edge cases: a text without words has fingerprint zero and is linked like any
other; null ids are passed over when a class looks for its smallest id (null if
it has no other); repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, ids_and_texts, packed, released, stored, unpacked

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Rows that a grid cell may hold by chance, on average.
PARTNERS = 64
#: Rows of a grid cell that one comparison block takes at most, on average.
CELL_ROWS = 1024

_HASH = partial(xxhash.xxh64_intdigest, seed=SEED)
_SLICE = 1 << 15  # shingles whose bits are unpacked at a time


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of UTF-8 text: a bit is set if over half of the shingle hashes have it."""
    words = text.lower().split()  # bytes: lower-cases A-Z only, splits at ASCII space only
    if not words:
        return 0
    if len(words) <= shingle:
        return _HASH(b" ".join(words))
    hashes = np.fromiter(map(_HASH, map(b" ".join, zip(*(words[i:] for i in range(shingle))))), np.uint64,
                         len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _SLICE):
        bits = np.unpackbits(hashes[i:i + _SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        marks = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
        rest = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "text"]
        names = [f.name for f in batch.schema if f.name != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(marks.view(np.int64))], names=[*names, "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp) for every row; fp is the 64 bits as a signed long."""
    rows = ids_and_texts(df, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_fingerprints, shingle), f"id {kind}, fp long")


def _unary(x):
    """The two-bit segments' popcounts of a long column, in unary."""
    low = 0x5555555555555555
    hi = F.shiftrightunsigned(x, 1)
    some, both = x.bitwiseOR(hi).bitwiseAND(F.lit(low)), x.bitwiseAND(hi).bitwiseAND(F.lit(low))
    return some.bitwiseOR(F.shiftleft(both, 1))


def grid_groups(nodes: int, max_bits: int = MAX_BITS) -> int:
    """Groups of segments, so that chance fills a cell with ``PARTNERS`` of so many fingerprints at most."""
    groups = max(2 * max_bits, 2)
    while groups < 2 * max_bits + 8 and nodes * (3 / 8) ** (32 * (1 - max_bits / groups)) > PARTNERS:
        groups += 1  # two counts are equal by chance in 3 of 8 cases
    return groups


def _cells(nodes: DataFrame, max_bits: int, groups: int) -> DataFrame:
    """(cell, fp): every fingerprint in one cell for each choice of groups; a cell is named by a hash, whose clashes
    only bring rows together that are then compared."""
    masks = [sum(3 << 2 * i for i in range(32) if i % groups in kept)
             for kept in combinations(range(groups), groups - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    u = _unary(F.col("fp"))
    return nodes.select("fp", u.alias("u")).select("fp", F.explode(F.array(*[
        F.xxhash64(F.col("u").bitwiseAND(F.lit(m)), F.lit(i)) for i, m in enumerate(signed)])).alias("cell"))


def _dealt(cells: DataFrame, cell_rows: int) -> DataFrame:
    """(cell, a, b, fp): large cells as blocks (a, b) of two chunks each."""
    large = (cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows)
             .select("cell", F.ceil(F.col("n") * 2 / cell_rows).cast("int").alias("k")))
    rows = cells.join(large, "cell", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("k")).cast("int")
    rows = rows.select("cell", "fp", own.alias("c"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    return rows.select("cell", F.least("c", "other").alias("a"), F.greatest("c", "other").alias("b"), "fp")


def _unary_np(x: np.ndarray) -> np.ndarray:
    low = np.uint64(0x5555555555555555)
    hi = x >> np.uint64(1)
    return ((x | hi) & low) | (((x & hi) & low) << np.uint64(1))


def _linked(a: np.ndarray, b: np.ndarray, ua: np.ndarray, ub: np.ndarray, bits: int) -> np.ndarray:
    """Where two fingerprints differ in at most ``bits`` bits: lower bound first, then exactly."""
    near = np.bitwise_count(ua ^ ub) <= bits
    near[near] = np.bitwise_count((a ^ b)[near]) <= bits
    return near


def _star(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each row of a block to the first row of its class inside the block."""
    n, u = len(fps), _unary_np(fps)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= bits
    i, j = np.nonzero(near)
    true = np.bitwise_count(fps[i] ^ fps[j]) <= bits
    i, j = i[true], j[true]
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        low = low[low]
        if (low == label).all():
            break
        label = low
    away = np.nonzero(label != np.arange(n))[0]
    return fps[away], fps[label[away]]


def _block_edges(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of blocks whose rows come one after another (sorted by cell, a, b)."""
    kept: list[np.ndarray] | None = None

    def edges(key: list[np.ndarray], fps: np.ndarray) -> pa.RecordBatch:
        same = np.ones(len(fps) - 1, bool)
        for k in key:
            same &= k[1:] == k[:-1]
        starts = np.concatenate([[0], np.nonzero(~same)[0] + 1, [len(fps)]])
        sizes = np.diff(starts)
        run = np.repeat(np.arange(len(sizes)), sizes)
        u, found = _unary_np(fps), []
        small = sizes <= 4
        for lag in (1, 2, 3):  # of small blocks, all pairs: six at most
            i = np.nonzero((run[lag:] == run[:-lag]) & small[run[lag:]])[0] if len(fps) > lag else []
            if len(i):
                i = i[_linked(fps[i], fps[i + lag], u[i], u[i + lag], bits)]
                found.append((fps[i + lag], fps[i]))
        found += [_star(fps[starts[r]:starts[r + 1]], bits) for r in np.nonzero(~small)[0]]
        a = np.concatenate([x for x, _ in found] or [fps[:0]]).view(np.int64)
        b = np.concatenate([y for _, y in found] or [fps[:0]]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in released(batches):
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if kept is not None:
            cols = [np.concatenate(x) for x in zip(kept, cols)]
        if not len(cols[0]):
            continue
        last = np.ones(len(cols[0]), bool)  # rows of the last block wait for the next batch
        for k in cols[:3]:
            last &= k == k[-1]
        cut = int(np.nonzero(~last)[0][-1]) + 1 if not last.all() else 0
        if cut:
            yield edges([k[:cut] for k in cols[:3]], cols[3][:cut].view(np.uint64))
        kept = [x[cut:] for x in cols]
    if kept is not None and len(kept[0]):
        yield edges(kept[:3], np.ascontiguousarray(kept[3]).view(np.uint64))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS,
          groups: int | None = None) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints ``fp`` as all links of at most ``max_bits`` bits would."""
    groups = grid_groups(nodes.count(), max_bits) if groups is None else groups
    if not 0 <= max_bits < groups <= 32:
        raise ValueError("a grid needs more groups than differing bits, and 32 at most")
    blocks = _dealt(_cells(nodes, max_bits, groups), cell_rows)
    return (blocks.repartition("cell", "a", "b").sortWithinPartitions("cell", "a", "b", "fp")
            .mapInArrow(partial(_block_edges, max_bits), "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with an edge.

    Alternates large-star and small-star steps (Kiveris and others, 2014) until
    every edge goes from a node to its root; each round is written to the shared
    folder.  A round moves as many rows as there are edges, whatever the shape of
    the graph, and their number of rounds grows with its logarithm.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        pulled = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(pulled.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark


def classes(marks: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root): the class of every distinct fingerprint that is linked to another."""
    nodes = marks.select("fp").distinct()
    return components(links(nodes, max_bits)).select(F.col("node").alias("fp"), "root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: id, fingerprint (16 hex digits), component_id (the class's smallest id)."""
    marks = stored(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    groups = marks.groupBy("fp").agg(F.min("id").alias("low"))
    roots = classes(marks, max_bits)
    members = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = members.groupBy("root").agg(F.min("low").alias("component_id"))
    known = stored(members.join(lowest, "root").select("fp", "component_id"), "classes")
    return marks.join(known, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with one row of each class: that of the smallest id (null ids last; of ties, the first written)."""
    rows = df.select(packed(df), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    marked = rows.mapInArrow(partial(_fingerprints, shingle), f"row {kind}, fp long")
    marked = stored(marked.withColumn("place", F.monotonically_increasing_id()), "marked")
    keys = marked.select("place", "fp", F.col("row")[id_col].alias("id"))
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("best")
    first = keys.groupBy("fp").agg(best)
    roots = classes(keys, max_bits)
    members = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    stay = members.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.place").alias("place"))
    return unpacked(marked.join(stay, "place", "left_semi"), df)
