"""Language-model scores from a hashed maximum-entropy model.

Tokens are words and one end token a text.  The model factors a token's
probability by its class and its group inside the class,

    P(word | history) = P(class | history) * P(group | class, history) * P(word | group),

with ``CLASSES`` classes: one for the end token, one for each of the most
frequent words, and the rest by a hash of a word's first two bytes.  A class of
many words has ``GROUPS`` groups, by a hash of a word's last two bytes.  The
first two factors are maximum-entropy models (softmax) over hashed features: the
word before, the two words before (n-grams), and the word before the last alone
(a skip feature); those of a group are hashed together with its class.  The
tables of weights grow with the root of the number of distinct words
(``feature_bits``), and so does what is trained in one sequence: more text gives
larger tables and more sequences.
P(word | group) is the maximum-entropy model that has a feature for each word,
whose solution is the smoothed share of the word in its group, with one place
kept for words never seen, so that each distribution adds up to one.

Training: counts come first, as one aggregate.  The training texts are then
dealt into lots of about ``LOT`` tokens a row of the tables by a hash of the text, and put in order
of that hash.  Each lot takes gradient steps, in batches of ``BATCH`` tokens,
from the same start (the shares), and the lots' weights are averaged feature by
feature, weighted by how often each lot saw the feature.  All training texts
are used, whole.  Equal texts are summed up before the shuffle, and are one text
with their number as its weight, so that a large group of copies fills no lot.
Lots follow from the texts alone, so scores don't depend on how rows are
partitioned, up to the rounding of sums.

Scoring reads all texts once more.  Counts of the ``FREQUENT`` most frequent
words of ``LONGEST`` bytes at most, a bounded size, go to all tasks; the counts
of all others are joined by a shuffle on the word, with one row for each text
and word in it.  Those are rare words, and long ones, whose groups Spark's
skew-join handling splits if one is in many texts.

Edge cases: a null text is the empty one, and has the end token alone; a null id
counts as the empty string in the split (so it is held out); repeated rows are
scored each; without training texts all counts are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import groupby, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ids_and_texts, stored
from .quality import bucket

CLASSES, SINGLES, GROUPS = 32, 8, 16
#: Rows of a table of weights, as powers of two: with the most, both tables take 200 MB in the driver and in each task.
LEAST_BITS, MOST_BITS = 15, 20
BATCH, RATE, SATURATION = 8192, 0.05, 8
#: Tokens of a lot for each row of a table: a lot's weights stay below a seventh or so of its text.
LOT = 128
#: Sums of weights beyond it count as this; it keeps their exponentials in range.
STEEP = 40.0
FREQUENT = 300_000
#: Bytes of a word that is sent to all tasks, at most: with ``FREQUENT``, the bound of what is broadcast.
LONGEST = 256
#: Bytes of text, or one text, that a task has in arrays at a time.
TOGETHER = 2_000_000
ADD = 0.1  # added to every count, as the base score does
END = b""


def held_out(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return ids_and_texts(df, id_col, text_col).withColumn("held_out", held_out(F.col("id")))


def _tokens(texts: pa.Array | list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens of some texts, the number among them of each token, text after text, and the texts' lengths."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
    whole = pc.fill_null(column.cast(pa.binary()).view(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(whole))  # A-Z and ASCII space only
    words = lists.flatten().dictionary_encode()
    # leading, trailing and no space at all give empty words: these are dropped, and the end token is one, too
    distinct, at = words.dictionary.cast(pa.binary()), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    end = pc.index(distinct, pa.scalar(END, pa.binary())).as_py()
    if end < 0:
        end, distinct = len(distinct), pa.concat_arrays([distinct, pa.array([END], pa.binary())])
    is_word = at != end
    upto = np.concatenate([[0], np.cumsum(is_word)])
    edges = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(upto[edges - edges[0]]) + 1
    out = np.full(int(sizes.sum()), end, np.int64)
    place = np.ones(len(out), bool)
    place[np.cumsum(sizes) - 1] = False
    out[place] = at[is_word]
    return distinct, out, sizes


def _bytes_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes | None]:
    for t in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()):
        yield t.as_py()


def _listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
    """The texts of a batch in groups of about ``TOGETHER`` bytes, with the place of the first."""
    texts = batch.column(batch.schema.get_field_index("text"))
    first, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= TOGETHER:
            yield first, texts.slice(first, i + 1 - first)
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts.slice(first)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for _, texts in _groups(batch):
            words, at, _ = _tokens(texts)
            parts.append(pa.table([words, np.bincount(at, minlength=len(words))], names=["token", "n"]))
        if parts:
            sums = pa.concat_tables(parts).group_by("token").aggregate([("n", "sum")]).rename_columns(["token", "n"])
            yield from sums.filter(pc.greater(sums["n"], 0)).to_batches()


def many_leaf(token: bytes) -> int:
    return (SINGLES + crc32(token[:2]) % (CLASSES - SINGLES)) * GROUPS + crc32(token[-2:]) % GROUPS


class Classes:
    """The leaf of a token, its class and group as one number, here and as a Column."""

    def __init__(self, singles: list[bytes]):
        self.singles = {END: 0} | {w: i + 1 for i, w in enumerate(singles[:SINGLES - 1])}

    def of(self, token: bytes) -> int:
        known = self.singles.get(token)
        if known is not None:
            return known * GROUPS
        return many_leaf(token)

    def column(self, token: Column) -> Column:
        class_ = SINGLES + F.crc32(F.substring(token, 1, 2)) % (CLASSES - SINGLES)
        out = class_ * GROUPS + F.crc32(F.substring(token, -2, 2)) % GROUPS
        for word, i in self.singles.items():
            out = F.when(token == F.lit(bytearray(word)), F.lit(i * GROUPS).cast("long")).otherwise(out)
        return out.cast("int")


def feature_bits(distinct: int) -> int:
    """The size of the tables of weights, as a power of two: about 32 times the root of the number of distinct words."""
    return min(max(round(math.log2(max(distinct, 1)) / 2) + 5, LEAST_BITS), MOST_BITS)


class _Codes:
    """The hash and the leaf of tokens in one number."""

    def __init__(self, classes: Classes):
        self.singles = pa.array(classes.singles, pa.binary())
        self.leaves = np.fromiter(classes.singles.values(), np.int64, len(classes.singles)) * GROUPS

    @staticmethod
    def _hashes(words: pa.Array) -> np.ndarray:
        return np.fromiter(map(crc32, _listed(words)), np.int64, len(words))

    def _few(self, words: pa.Array) -> np.ndarray:
        few = words.dictionary_encode()
        return self._hashes(few.dictionary)[few.indices.to_numpy()]

    def of(self, words: pa.Array) -> np.ndarray:
        """As ``Classes.of`` has the leaves, for many tokens."""
        class_ = SINGLES + self._few(pc.binary_slice(words, 0, 2)) % (CLASSES - SINGLES)
        leaf = class_ * GROUPS + self._few(pc.binary_slice(words, -2)) % GROUPS
        single = pc.fill_null(pc.index_in(words, value_set=self.singles), -1).to_numpy(zero_copy_only=False)
        leaf = np.where(single >= 0, self.leaves[single], leaf)
        return (self._hashes(words) | 1 << 32) << 16 | leaf


def _batch_arrays(texts: pa.Array | list[bytes | None], codes: _Codes):
    """Tokens of a batch of texts: the distinct ones, which of them is at each place, the texts' lengths, the leaf and the
    three features (64 bits) of each place."""
    words, at, sizes = _tokens(texts)
    codes = codes.of(words)[at]
    hashes = codes >> 16
    ends = np.cumsum(sizes)
    h1 = np.concatenate([[0], hashes])[:len(at)]
    h2 = np.concatenate([[0, 0], hashes])[:len(at)]
    starts = ends - sizes
    h1[starts] = 0
    h2[starts] = 0
    second = (starts + 1)[sizes > 1]
    h2[second] = 1
    mix = lambda x, by: x.astype(np.uint64) * np.uint64(by)
    features = np.stack([mix(h1 + 7, 0x9E3779B97F4A7C15), mix(h1 * 31 + h2 * 1_000_003 + 11, 0xC2B2AE3D27D4EB4F),
                         mix(h2 + 13, 0x165667B19E3779F9)])
    return words, at, sizes, codes & 0xFFFF, features


def class_rows(features: np.ndarray, bits: int) -> np.ndarray:
    return (features >> np.uint64(64 - bits)).astype(np.int32)


def group_rows(features: np.ndarray, classes: np.ndarray, bits: int) -> np.ndarray:
    mixed = (features ^ (features >> np.uint64(29))) + (classes + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return class_rows(mixed * np.uint64(0x9FB21C651E98DF25), bits)


def softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = np.take(weights, rows[0], axis=0, mode="clip")
    z += np.take(weights, rows[1], axis=0, mode="clip")
    z += np.take(weights, rows[2], axis=0, mode="clip")
    z += bias
    np.clip(z, -STEEP, STEEP, out=z)
    np.exp(z, out=z)
    z /= np.einsum("ij->i", z)[:, None]
    return z


class Head:
    """The weights of one factor while they are trained."""

    def __init__(self, bits: int, outcomes: int):
        self.weights = np.zeros((1 << bits, outcomes), np.float32)
        self.times = np.zeros(1 << bits, np.int64)
        self._last = np.zeros(1 << bits, np.int32)

    def _distinct(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct rows, and which of them each is; without a sort."""
        places = np.arange(len(rows), dtype=np.int32)
        self._last[rows] = places
        last = self._last[rows]
        is_last = last == places
        return rows[is_last], (np.cumsum(is_last) - 1)[last]

    def step(self, bias: np.ndarray, rows: np.ndarray, y: np.ndarray, much: np.ndarray) -> None:
        """One gradient step on the tokens of a batch, each as many times as ``much`` says."""
        error = softmax(self.weights, bias, rows)
        error[np.arange(len(y)), y] -= 1
        if (much != 1).any():
            error *= much[:, None]
        by_outcome = np.ascontiguousarray(error.T, dtype=np.float64)
        for feature in rows:
            used, at = self._distinct(feature)
            count = np.bincount(at, much)
            mean = np.empty((len(by_outcome), len(used)))
            for sums, e in zip(mean, by_outcome):
                sums[:] = np.bincount(at, e)
            mean *= RATE * np.minimum(count, SATURATION) / count
            self.weights[used] -= mean.T
            self.times[used] += count.astype(np.int64)


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch as one row."""
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by(["h", "lot", "text"]).aggregate([([], "count_all")])
        yield from sums.rename_columns(["h", "lot", "text", "times"]).to_batches()


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[int]]]:
    """(lot, texts, times) in groups of about ``TOGETHER`` bytes; equal texts, which are neighbours, are one."""
    lot, texts, times, size = None, [], [], 0
    for batch in batches:
        for t, at, k in zip(_bytes_of(batch), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if texts and at == lot and texts[-1] == t:
                times[-1] += k
                continue
            if texts and (at != lot or size >= TOGETHER):
                yield lot, texts, times
                texts, times, size = [], [], 0
            lot, size = at, size + len(t)
            texts.append(t)
            times.append(k)
    if texts:
        yield lot, texts, times


def _trained(leaf_n: np.ndarray, singles: list[bytes], bits: int, batches: Iterator[pa.RecordBatch]
             ) -> Iterator[pa.RecordBatch]:
    codes, (bias, inner_bias) = _Codes(Classes(singles)), start_bias(leaf_n)
    for _, parts in groupby(_lots(batches), key=lambda x: x[0]):
        outer, inner = Head(bits, CLASSES), Head(bits, GROUPS)
        for _, texts, times in parts:
            _, _, sizes, leaves, features = _batch_arrays(texts, codes)
            much = np.repeat(np.array(times, np.float32), sizes)
            for i in range(0, len(leaves), BATCH):
                y, x, k = leaves[i:i + BATCH], features[:, i:i + BATCH], much[i:i + BATCH]
                class_ = y // GROUPS
                outer.step(bias, class_rows(x, bits), class_, k)
                many = np.nonzero(class_ >= SINGLES)[0]
                if len(many):
                    class_ = class_[many]
                    inner.step(inner_bias[class_], group_rows(x[:, many], class_, bits), y[many] % GROUPS, k[many])
        yield from _rows_of(outer, 0)
        yield from _rows_of(inner, 1 << bits)


def _rows_of(head: Head, first: int) -> Iterator[pa.RecordBatch]:
    used = np.nonzero(head.times)[0]
    for some in np.array_split(used, max(1, len(used) // 4096)):
        columns = [pa.array(head.weights[some, c]) for c in range(head.weights.shape[1])]
        columns += [pa.array(np.zeros(len(some), np.float32))] * (len(_W) - len(columns))
        yield pa.RecordBatch.from_arrays([pa.array((some + first).astype(np.int32)), pa.array(head.times[some]), *columns],
                                         names=["feature", "times", *_W])


_W = [f"w{c}" for c in range(max(CLASSES, GROUPS))]


class Model:
    """Counts and weights, all of bounded size, as they are sent to the tasks."""

    def __init__(self, leaf_n: np.ndarray, leaf_v: np.ndarray, singles: list[bytes], frequent: list[tuple[bytes, int]],
                 bits: int, weights: np.ndarray, inner: np.ndarray):
        self.total, self.distinct, self.singles = int(leaf_n.sum()), int(leaf_v.sum()), singles
        self.bits, self.weights, self.inner = bits, weights, inner
        self.base_log = math.log10(self.total + ADD * (self.distinct + 1))
        self.leaf_log = np.log10(leaf_n + ADD * (leaf_v + 1))
        self.bias, self.inner_bias = start_bias(leaf_n)
        self.frequent = {w: i for i, (w, _) in enumerate(frequent)}
        logs = np.log10(np.array([n for _, n in frequent], np.float64) + ADD)
        classes = Classes(singles)
        of = np.array([classes.of(w) for w, _ in frequent], np.int64)
        self.base = logs - self.base_log
        self.inside = logs - self.leaf_log[of] if len(of) else logs

    def log_leaf(self, leaves: np.ndarray, features: np.ndarray) -> np.ndarray:
        """log10 of P(class | history) * P(group | class, history) of each token."""
        class_, at = leaves // GROUPS, np.arange(len(leaves))
        logs = np.log10(softmax(self.weights, self.bias, class_rows(features, self.bits))[at, class_], dtype=np.float64)
        many = np.nonzero(class_ >= SINGLES)[0]
        if len(many):
            class_ = class_[many]
            p = softmax(self.inner, self.inner_bias[class_], group_rows(features[:, many], class_, self.bits))
            logs[many] += np.log10(p[np.arange(len(many)), leaves[many] % GROUPS], dtype=np.float64)
        return logs


def start_bias(leaf_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the shares of the classes, and of the groups in each class."""
    logs = lambda n: np.log((n + 1.0) / (n + 1.0).sum(-1, keepdims=True)).astype(np.float32)
    by_class = leaf_n.reshape(CLASSES, GROUPS)
    return logs(by_class.sum(1)), logs(by_class)


_PARTS = ("place long, id {}, held_out boolean, token binary, leaf_log double, n_tokens long, n_known long, base_score double, "
          "score double")


def _scored(shared, kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text a row of what is known here, and a row for each rare word (``n_tokens`` times)."""
    model: Model = shared.value
    codes, known = _Codes(Classes(model.singles)), model.frequent.get
    for batch, texts in ((batch.slice(first, len(texts)), texts) for batch in batches for first, texts in _groups(batch)):
        places = batch.column(batch.schema.get_field_index("place")).to_pylist()
        words, word, sizes, leaves, features = _batch_arrays(texts, codes)
        at = np.fromiter(map(known, _listed(words), repeat(-1)), np.int64, len(words))[word]
        logs = np.empty(len(word))
        for i in range(0, len(word), BATCH):
            logs[i:i + BATCH] = model.log_leaf(leaves[i:i + BATCH], features[:, i:i + BATCH])
        doc = np.repeat(np.arange(len(sizes)), sizes)
        found = at >= 0
        sums = lambda x, w: np.bincount(doc[w], x[w], len(sizes))
        base = np.where(found, model.base[at] if len(model.base) else 0.0, 0.0)
        logs += np.where(found, model.inside[at] if len(model.inside) else 0.0, 0.0)
        everywhere = np.ones(len(word), bool)
        unknown = np.nonzero(~found)[0]
        rare, first, times = np.unique(doc[unknown] * len(words) + word[unknown], return_index=True, return_counts=True)
        n, m = len(sizes), len(rare)
        index = (rare // len(words)).tolist()
        ids = batch.column(batch.schema.get_field_index("id")).cast(kind)
        out = batch.column(batch.schema.get_field_index("held_out"))
        nothing = pa.nulls(m, pa.float64())
        yield pa.RecordBatch.from_arrays([
            pa.array(places + [places[d] for d in index], pa.int64()),
            pa.concat_arrays([ids, pa.nulls(m, kind)]), pa.concat_arrays([out, pa.nulls(m, pa.bool_())]),
            pa.concat_arrays([pa.nulls(n, pa.binary()), words.take(pa.array(rare % len(words)))]),
            pa.concat_arrays([pa.nulls(n, pa.float64()), pa.array(model.leaf_log[leaves[unknown[first]]])]),
            pa.array(np.concatenate([sizes, times])),
            pa.concat_arrays([pa.array(sums(found.astype(float), found).astype(np.int64)), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(sums(base, found)), nothing]),
            pa.concat_arrays([pa.array(sums(logs, everywhere)), nothing])],
            names=["place", "id", "held_out", "token", "leaf_log", "n_tokens", "n_known", "base_score", "score"])


def _most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words of the highest counts, ``most`` at most, in order: those above a bound that is read off the number
    of words for each size of count (a few hundred rows), so that nothing is sorted as a whole."""
    counts = counts.where(F.octet_length("token") <= LONGEST)
    sizes = sorted(((r.b, r.v) for r in counts.groupBy(bucket(F.col("n")).alias("b")).agg(F.count(F.lit(1)).alias("v"))
                    .collect()), reverse=True)
    least, held = None, 0
    for b, v in sizes:
        held += v
        if held > most:
            break
        least = b
    if least is None:
        return []
    got = counts.where(F.col("n") >= least).toArrow()
    return sorted(zip(got["token"].to_pylist(), got["n"].to_pylist()), key=lambda x: (-x[1], x[0]))


def _dealt(training: DataFrame, lots: int) -> DataFrame:
    """(text, lot, times): each lot in one partition, in order of the texts' hashes, which make up the lots."""
    h = F.col("h")
    lot = F.least(F.floor((h.cast("double") / float(1 << 64) + 0.5) * lots), F.lit(lots - 1)).cast("int")
    keyed = training.select(F.xxhash64("text").alias("h"), "text").select("h", lot.alias("lot"), "text")
    once = keyed.mapInArrow(_collapsed, "h long, lot int, text string, times long")
    return once.repartitionById(lots, F.col("lot")).sortWithinPartitions("h", "text").select("text", "lot", "times")


def train(texts: DataFrame, frequent: int = FREQUENT, lot: float = LOT) -> tuple[Model, DataFrame]:
    """The model of all ``texts`` that aren't held out, and the table of counts (token, n)."""
    training = texts.where(~F.col("held_out")).select("text")
    counts = stored(training.mapInArrow(_counted, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")),
                    "counts")
    top = _most_frequent(counts, frequent)
    singles = [w for w, _ in top[:SINGLES] if w != END][:SINGLES - 1]
    classes = Classes(singles)
    by_leaf = counts.groupBy(classes.column(F.col("token")).alias("leaf")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # CLASSES * GROUPS rows at most
    leaf_n, leaf_v = np.zeros(CLASSES * GROUPS), np.zeros(CLASSES * GROUPS)
    for r in by_leaf:
        leaf_n[r.leaf], leaf_v[r.leaf] = r.n, r.v
    bits = feature_bits(int(leaf_v.sum()))
    kinds = ", ".join(f"{w} float" for w in _W)
    dealt = _dealt(training, max(1, math.ceil(leaf_n.sum() / (lot * (1 << bits)))))
    each = dealt.mapInArrow(partial(_trained, leaf_n, singles, bits), f"feature int, times long, {kinds}")
    mean = each.groupBy("feature").agg(*[(F.sum(F.col(w) * F.col("times")) / F.sum("times")).cast("float").alias(w)
                                         for w in _W])
    weights = np.zeros((2 << bits, len(_W)), np.float32)
    got = mean.toArrow()  # the tables' rows, 2 << MOST_BITS at most
    rows = got["feature"].to_numpy()
    for c, w in enumerate(_W):
        weights[rows, c] = got[w].to_numpy()
    outer, inner = weights[:1 << bits, :CLASSES], np.ascontiguousarray(weights[1 << bits:, :GROUPS])
    return Model(leaf_n, leaf_v, singles, top, bits, np.ascontiguousarray(outer), inner), counts


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``df``: the id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    texts = _texts(df, id_col, text_col)
    model, counts = train(texts, frequent)
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = texts.withColumn("place", F.monotonically_increasing_id())
    kind = rows.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    parts = stored(rows.mapInArrow(partial(_scored, shared, to_arrow_type(kind)), _PARTS.format(kind.simpleString())),
                   "parts")
    rare = parts.where("token is not null").select("place", "token", "leaf_log", F.col("n_tokens").alias("k"))
    met = rare.join(counts, "token", "left")
    seen = F.coalesce("n", F.lit(0)) + F.lit(ADD)
    rest = met.select(
        "place", F.lit(None).cast(kind).alias("id"), F.lit(None).cast("boolean").alias("held_out"),
        F.lit(0).cast("long").alias("n_tokens"), F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0).alias("n_known"),
        (F.col("k") * (F.log10(seen) - F.lit(model.base_log))).alias("base_score"),
        (F.col("k") * (F.log10(seen) - F.col("leaf_log"))).alias("score"))
    whole = parts.where("token is null").select(*rest.columns)
    sums = whole.unionByName(rest).groupBy("place").agg(
        F.max("id").alias(id_col), F.max("held_out").alias("held_out"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.select(id_col, "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                       "base_score", "score")
