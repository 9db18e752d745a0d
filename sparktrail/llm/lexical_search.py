"""Ranked lexical search the other way round: items wait, documents pass by.

The items' terms make an inverted index (term -> items), which every task holds.
A first pass splits each document into terms and keeps its length and the counts
of the terms that the index has; from it come the number of documents and terms,
and the document frequency of each indexed term.  A second pass streams these
counts through the index: each document adds to the scores of the items that
share a term with it, and each item has a heap of its best k documents.  The
tasks' heaps are merged in two rounds.

Terms are the maximal runs of ASCII letters and digits and of characters beyond
ASCII, only A-Z lower-cased.  The score is a sum of whole numbers (see
``weight`` and ``_scores``), so it depends on no order.

Scale: a task holds one index and one heap for each item, and a few thousand
documents at a time.  Items are dealt into blocks by a hash, so many that an
index is about ``BLOCK_BYTES``; each block is one run over all documents, and all
items are searched.  One item's terms must fit into a task, as must one text.
Heaps have k rows an item and task; the first round merges the tasks in
``_ROUND`` groups, the second these.

Edge cases: null and empty texts have no terms, aren't counted and aren't found;
an item without terms, or whose terms no document has, has no rows; repeated
items have rows of their own; repeated documents each take a rank; equal scores
go by ascending id, null ids last; a document scores above 0 or isn't returned;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, stored

TOP = 10
#: Bytes of terms in the index of one block.
BLOCK_BYTES = 32 << 20
#: Scores worked on at once in a task.
_TOGETHER = 1 << 20
_ROUND = 64
#: All bytes that end a term as a space, A-Z as a-z.
_SPACED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                for b in range(256))
#: What is not a term's character, for the JVM.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SPACED).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _counted(ids: dict[bytes, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, terms, tfs): each document's length, the numbers of its indexed terms, and their counts."""
    for batch in batches:
        sizes, ends, terms, tfs = [], [0], [], []
        for text in batch.column(1):
            words = terms_of(text.as_py())
            sizes.append(len(words))
            for word, n in Counter(words).items():
                number = ids.get(word)
                if number is not None:
                    terms.append(number)
                    tfs.append(n)
            ends.append(len(terms))
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
             pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["id", "n", "terms", "tfs"])


class Index:
    """Items by term: ``ids`` numbers the terms; the items of term t are ``items[starts[t]:starts[t + 1]]``."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.places = [place for place, _ in rows]
        self.ids: dict[bytes, int] = {}
        pairs = [(self.ids.setdefault(t.encode(), len(self.ids)), i) for i, (_, terms) in enumerate(rows) for t in terms]
        pairs = np.array(pairs, np.int64).reshape(-1, 2)
        self.items = pairs[np.argsort(pairs[:, 0], kind="stable"), 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(pairs[:, 0], minlength=len(self.ids)))])


def _scores(index: Index, weights: np.ndarray, n: list[int], n_docs: int, n_terms: int, ends: np.ndarray,
            terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
    """Scores (document, item): the sum over shared terms of w * ((10^9 tf) div (1000 tf + 8 m))."""
    m = np.array([100 - 90 + 90 * x * n_docs // n_terms for x in n], np.int64)
    doc = np.repeat(np.arange(len(n)), np.diff(ends))
    part = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[doc]))
    width = index.starts[terms + 1] - index.starts[terms]
    entry = np.repeat(np.arange(len(terms)), width)
    place = np.arange(len(entry)) - np.repeat(np.cumsum(width) - width, width)
    item = index.items[index.starts[terms][entry] + place]
    scores = np.zeros(len(n) * len(index.places), np.int64)
    np.add.at(scores, doc[entry] * len(index.places) + item, part[entry])
    return scores.reshape(len(n), len(index.places))


def _heaps(index: Index, weights: np.ndarray, n_docs: int, n_terms: int, k: int,
           batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, id, score, task): the best k documents of each item among a task's."""
    width = len(index.places)
    heaps: list[list] = [[] for _ in range(width)]  # (score, known id, -id): the worst first
    least, last = np.ones(width, np.int64), np.full(width, np.iinfo(np.int64).max)  # what a document must beat

    def offer(rows: list, scores: np.ndarray) -> None:
        number = np.array([x if x is not None else np.iinfo(np.int64).max for x in rows], np.int64)
        better = (scores > least) | ((scores == least) & (number[:, None] < last))
        for d, i in zip(*np.nonzero(better)):
            heap, x = heaps[i], rows[d]
            entry = (int(scores[d, i]), x is not None, -(x or 0))
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == k:
                least[i], last[i] = heap[0][0], -heap[0][2] if heap[0][1] else np.iinfo(np.int64).max

    for batch in batches:
        ids, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        lists = batch.column(2)
        ends = lists.offsets.to_numpy().astype(np.int64)
        terms = lists.values.to_numpy()[ends[0]:ends[-1]]
        tfs = batch.column(3).values.to_numpy()[ends[0]:ends[-1]]
        ends = ends - ends[0]
        cost = np.cumsum(np.concatenate([[0], index.starts[terms + 1] - index.starts[terms]]))[ends]
        cost = cost + width * np.arange(len(ends))
        i = 0
        while i < len(ids):
            j = max(i + 1, int(np.searchsorted(cost, cost[i] + _TOGETHER, "right")) - 1)
            a, b = ends[i], ends[j]
            offer(ids[i:j], _scores(index, weights, n[i:j], n_docs, n_terms, ends[i:j + 1] - a, terms[a:b], tfs[a:b]))
            i = j
    found = [(index.places[i], -x if known else None, score) for i, heap in enumerate(heaps) for score, known, x in heap]
    task = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [*(pa.array([r[c] for r in found], pa.int64()) for c in range(3)), pa.array([task] * len(found), pa.int64())],
        names=["place", "id", "score", "task"])


def _best(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy("place", *by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = TOP,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of each item: the item's id, rank from 1, the document's (integer) id, score."""
    text = F.translate(F.coalesce(col(item_text_col).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    words = F.array_distinct(F.filter(F.split(text, _GAP), lambda t: t != ""))
    asked = stored(items.select(F.monotonically_increasing_id().alias("place"), col(item_col).alias("item"),
                                words.alias("terms")).where(F.size("terms") > 0), "items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 16)
    blocks = max(1, math.ceil((asked.agg(F.sum(size)).first()[0] or 0) / block_bytes))
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").cast("binary").alias("text"))
    texts = texts.where(F.col("text").isNotNull())
    totals, heaps = None, []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("place"), F.lit(blocks)) == block)
        index = Index([(r.place, r.terms) for r in mine.select("place", "terms").collect()])  # about block_bytes
        if not index.places:
            continue
        counts = stored(texts.mapInArrow(partial(_counted, index.ids), "id long, n long, terms array<int>, tfs array<long>")
                        .where("n > 0"), "counts")
        totals = totals or counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        n_docs, n_terms = totals[0], totals[1] or 1
        weights = np.full(len(index.ids), weight(n_docs, 0), np.int64)
        # at most a row for each indexed term
        for number, df in counts.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            weights[number] = weight(n_docs, df)
        heaps.append(counts.where(F.size("terms") > 0).mapInArrow(partial(_heaps, index, weights, n_docs, n_terms, k),
                                                                  "place long, id long, score long, task long"))
    if not heaps:
        return items.select(col(item_col).alias(item_col), F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id_col),
                            F.lit(0).cast("long").alias("score")).limit(0)
    found = heaps[0]
    for more in heaps[1:]:
        found = found.union(more)
    found = _best(found.withColumn("part", F.pmod("task", F.lit(_ROUND))), k, "part").drop("rank")
    best = _best(found, k)
    return best.join(asked.select("place", "item"), "place").select(
        F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
