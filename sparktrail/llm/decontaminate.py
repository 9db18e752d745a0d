"""Benchmark decontamination by template canonicalisation.

Texts are put into a canonical form: numbers become a typed placeholder, so do
names (capitalised words inside a sentence) and units after a number; all other
words are lower-cased and stand alone.  A capitalised word elsewhere, as at a
sentence's start, is a name in a document that has it as a name inside a sentence
too and never in lower case; a window of the benchmark has a row for each way to
read such words, so that it meets either form.  A question whose numbers or names
were replaced keeps its form.  Windows of ``WINDOW`` canonical words are hashed, and
the windows of the documents are joined with those of the benchmark.  Windows
found on one diagonal (same document, item, and difference of places) make up a
candidate, and so do those of diagonals that lie at most ``MAX_DRIFT`` words
apart, one after the other, since each inserted or deleted word starts a new one;
there, a place of the document and one of the item count once, on the diagonal
that has more.  A candidate counts as a leak if it covers at least ``COVER`` of
the item's windows, or a diagonal covers ``RUN`` words of the item in a row, and
if its slots are consistent: within the candidate, equal slot values of the item
have equal values in the document (different ones may have become equal).

Only DataFrame functions are used.  The windows of the benchmark are written
down first and broadcast if they are at most ``MAX_BROADCAST`` rows; beyond, the
join is by a shuffle on the hash.  Windows of the documents are made, hashed and
joined in one pass, so that without the shuffle only hits are moved.

Edge cases: null and empty texts and items have no windows; items of fewer words
than a window are one window of all their words, and the documents' windows of
that many words are hashed too (one pass for each length that the benchmark
has); items of fewer than ``MIN_WORDS`` words are too common to tell.  Windows
with fewer than ``MIN_WORDS`` words that aren't placeholders are left out on the
benchmark's side, unless the item has no other: those are hits only where all
their slot values are the document's. So are those of an item of one window, as
one window with other values is no more than a like question.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, stored

WINDOW = 8
COVER = 0.5
#: Words by which neighbouring diagonals of one candidate differ, at most; words in a row that are a leak by themselves.
MAX_DRIFT, RUN = 8, 13
#: Words of a window that are not placeholders, at least.
MIN_WORDS = 4
MAX_BROADCAST = 500_000
#: Units that are placeholders when they follow a number.
UNITS = ("mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hours minutes seconds days weeks months years "
         "percent dollars euros usd eur meters metres miles kilometers kilometres grams pounds liters litres").split()

_NAME = "\u0001"  # stands before a word that is a name; can't be part of a word itself
_MAYBE = "\u0002"  # stands before a capitalised word that isn't inside a sentence


def _words(text: Column) -> Column:
    """Words, lower-cased, with a mark before names and another before words that may be names.  Numbers may have points
    and commas inside."""
    clean = F.translate(text, _NAME + _MAYBE, "  ")
    marked = F.regexp_replace(clean, r"(?<=[\p{L}\p{N},;:)] )(?=\p{Lu}\p{Ll})", _NAME)
    marked = F.regexp_replace(marked, rf"(?<![\p{{L}}\p{{M}}\p{{N}}{_NAME}])(?=\p{{Lu}}\p{{Ll}})", _MAYBE)
    return F.array_remove(F.split(F.lower(marked), rf"(?:(?!(?<=\p{{N}})[.,](?=\p{{N}}))[^\p{{L}}\p{{M}}\p{{N}}{_NAME}{_MAYBE}])+"),
                          "")


def _bare(word: Column) -> Column:
    return F.substring(word, 2, 1 << 30)


def _names(words: Column) -> Column:
    """The words that may be names and are: those that are names elsewhere in the text, and nowhere in lower case."""
    marked = lambda mark: F.transform(F.filter(words, lambda w: w.startswith(mark)), _bare)
    return F.array_except(F.array_intersect(marked(_MAYBE), marked(_NAME)), words)


def _code(word: Column, before: Column) -> Column:
    """The hash of an ordinary word, else its kind of placeholder: 1 number, 2 name, 3 unit."""
    number = lambda w: w.between("0", "9\U0010FFFF")
    return (F.when(number(word), F.lit(1).cast("long")).when(word < "0", 2)
            .when(word.isin(UNITS) & number(before), 3).otherwise(F.xxhash64(word)))


def _coded(texts: DataFrame) -> DataFrame:
    """(key, words, n, codes) of each text."""
    rows = texts.select("key", _words(F.col("text")).alias("words"))
    # the names are bound once as an element, so that they aren't worked out again for each word
    read = F.transform(F.array(_names(F.col("words"))), lambda names: F.transform("words", lambda w: F.when(
        w.startswith(_MAYBE), F.concat(F.when(F.array_contains(names, _bare(w)), F.lit(_NAME)).otherwise(""), _bare(w)))
        .otherwise(w)))
    rows = rows.select("key", F.get(read, 0).alias("words"))
    return rows.select("key", "words", F.size("words").alias("n"), F.transform(
        "words", lambda w, i: _code(w, F.get("words", i - 1))).alias("codes"))


def _is_slot(code: Column) -> Column:
    return code.between(0, 3)


def _held(place: Column, size: Column | int) -> Column:
    """The slot values of a window in order."""
    return F.filter(F.slice("words", place + 1, size), lambda w, j: _is_slot(F.get("codes", place + j)))


def _windows(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, w): the windows of each text in order, as structs of place, hash and slot values (null if none), for each size.

    To be exploded with ``explode_outer``: for an inner one, the optimizer would
    test the array's size below and so work it out twice.
    """
    rows = _coded(texts)
    none = F.lit(None).cast("array<string>").alias("slots")
    hashed = lambda p, size: F.xxhash64(*[F.get("codes", p + k) for k in range(size)]).alias("h")

    def of(size: int) -> Column:
        places = F.sequence(F.lit(0), F.col("n") - size)
        whole = F.when(F.exists("codes", _is_slot), F.transform(places, lambda p: F.struct(
            p.alias("place"), hashed(p, size), _held(p, F.lit(size)).alias("slots")))).otherwise(
            F.transform(places, lambda p: F.struct(p.alias("place"), hashed(p, size), none)))
        empty = F.array().cast("array<struct<place:int,h:bigint,slots:array<string>>>")
        return F.when(F.col("n") >= size, whole).otherwise(empty)

    return rows.select("key", (F.concat(*map(of, sizes)) if len(sizes) > 1 else of(sizes[0])).alias("w"))


def _text(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def _readings(words: Column) -> Column:
    """All ways to read a window's words that may be names, as names or not; first the one without."""
    both = lambda v, w: F.array(F.array_append(v, _bare(w)), F.array_append(v, F.concat(F.lit(_NAME), _bare(w))))
    return F.aggregate(words, F.array(F.array().cast("array<string>")), lambda vs, w: F.when(
        w.startswith(_MAYBE), F.flatten(F.transform(vs, lambda v: both(v, w)))).otherwise(
        F.transform(vs, lambda v: F.array_append(v, w))))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """(item, at, size, strict, h, asked, of): the windows of each item that can be told apart, each once for each way to
    read it, their number of words, whether their slot values must be the document's, their slot values (null if none),
    and their number.

    An item is its id and text, so that repeated rows count once."""
    key = F.struct(col(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("t")).alias("key")
    rows = benchmark.select(key, _text(text_col).alias("text")).distinct()
    rows = rows.select("key", _words(F.col("text")).alias("words")).where(F.size("words") >= MIN_WORDS)
    n = F.size("words")
    each = rows.select("key", "words", F.least(n, F.lit(window)).alias("size"), F.explode(F.sequence(
        F.lit(0), F.greatest(n - window, F.lit(0)))).alias("at"))
    each = each.select(F.col("key").alias("item"), "at", "size", F.get("words", F.col("at") - 1).alias("before"),
                       _readings(F.slice("words", F.col("at") + 1, F.col("size"))).alias("readings"))
    each = each.select("item", "at", "size", F.transform("readings", lambda v: F.struct(v.alias("words"), F.transform(
        v, lambda w, j: _code(w, F.coalesce(F.get(v, j - 1), F.col("before")))).alias("codes"))).alias("readings"))
    few_plain = lambda v: F.size(F.filter(v["codes"], lambda c: ~_is_slot(c))) < MIN_WORDS
    each = each.select("item", "at", "size", few_plain(F.get("readings", 0)).alias("weak"), F.explode("readings").alias("v"))
    v = F.col("v")
    asked = F.filter(v["words"], lambda w, j: _is_slot(F.get(v["codes"], j)))
    each = each.select("item", "at", "size", "weak", few_plain(v).alias("strict"), F.xxhash64(v["codes"]).alias("h"),
                       F.when(F.size(asked) > 0, asked).alias("asked"))
    count = each.groupBy(F.col("item").alias("item_")).agg(
        F.count_distinct(F.when(~F.col("weak"), F.col("at"))).alias("told"), F.count_distinct("at").alias("all"))
    same = F.col("item").eqNullSafe(F.col("item_"))
    of = F.when(F.col("told") > 0, F.col("told")).otherwise(F.col("all"))
    return each.join(count, same).where((F.col("told") == 0) | ~F.col("weak")).select(
        "item", "at", "size", (F.col("strict") | (of == 1)).alias("strict"), "h", "asked", of.alias("of"))


def _candidates(hits: DataFrame) -> DataFrame:
    """(key, item, cand, at, size, of, asked, found): the hits of each diagonal, and again those of neighbouring ones."""
    pair = Window.partitionBy("key", "item")
    kept = ["size", "of", "asked", "found"]
    cand = lambda merged, at: F.struct(F.lit(merged).alias("merged"), at.alias("at")).alias("cand")
    single = hits.select("key", "item", cand(False, F.col("shift")), "at", *kept)
    apart = F.coalesce(F.col("shift") - F.lag("shift").over(pair.orderBy("shift")) > MAX_DRIFT, F.lit(False))
    rows = hits.withColumn("apart", apart.cast("int"))
    rows = rows.withColumn("cluster", F.sum("apart").over(pair.orderBy("shift"))).withColumn(
        "rank", F.struct(F.count(F.lit(1)).over(Window.partitionBy("key", "item", "shift")).alias("n"), (-F.col("shift")).alias("s")))
    near = Window.partitionBy("key", "item", "cluster")
    rows = rows.withColumn("several", F.max("shift").over(near) > F.min("shift").over(near)).where("several")
    each = ["key", "item", "cluster"]
    best = lambda by, other: rows.groupBy(*each, by).agg(
        F.max_by(F.struct(other, "rank", *kept), "rank").alias("b"))
    rows = best("place", "at").select(*each, "place", "b.*")
    rows = best("at", "place").select(*each, "at", "b.*")
    return single.unionByName(rows.select("key", "item", cand(True, F.col("cluster").cast("int")), "at", *kept))


def _run(ats: Column, size: Column) -> Column:
    """The most words in a row that windows at these sorted places cover."""
    start = F.struct(F.lit(0).alias("first"), F.lit(-1).alias("end"), F.lit(0).alias("best"))

    def step(s: Column, at: Column) -> Column:
        first = F.when(at <= s["end"], s["first"]).otherwise(at)
        return F.struct(first.alias("first"), (at + size).alias("end"), F.greatest(s["best"], at + size - first).alias("best"))

    return F.aggregate(ats, start, step, lambda s: s["best"])


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """A row for each (id, text hash, item) that leaks: share of the item's windows found, number of its slot values,
    and whether all of them are the document's."""
    items = stored(benchmark_windows(benchmark, item_col, item_text_col, window), "items")
    few = items.count() <= MAX_BROADCAST
    key = F.struct(col(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("t")).alias("key")
    short = sorted(r["size"] for r in items.where(F.col("size") < window).select("size").distinct().collect())
    docs = _windows(df.select(key, _text(text_col).alias("text")), [window, *short])
    each = docs.select("key", F.explode_outer("w").alias("w")).select(
        "key", "w.place", "w.h", F.when(F.size("w.slots") > 0, F.col("w.slots")).alias("found"))
    hits = each.join(F.broadcast(items) if few else items, "h").where(
        ~F.col("strict") | F.col("asked").eqNullSafe(F.col("found"))).select(
        "key", "item", "at", "place", (F.col("place") - F.col("at")).alias("shift"), "size", "of", "asked", "found")
    hits = _candidates(stored(hits, "hits"))
    group = ["key", "item", "cand"]
    share = hits.groupBy(*group).agg(F.array_sort(F.collect_set("at")).alias("ats"), F.max("of").alias("of"), F.max("size").alias("size"))
    share = share.select(*group, (F.size("ats") / F.col("of")).alias("share"), _run(F.col("ats"), F.col("size")).alias("run"))
    share = share.where((F.col("share") >= cover) | (F.col("run") >= RUN) & ~F.col("cand.merged"))
    pairs = hits.where(F.size("asked") > 0).select(*group, F.explode(F.arrays_zip("asked", "found")).alias("p"))
    pairs = pairs.select(*group, "p.*").distinct()
    told = pairs.groupBy(*group).agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("asked").alias("asked"),
        F.min(F.col("asked") == F.col("found")).alias("same"))
    same_group = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in group]
    both = share.alias("s").join(told.alias("t"), same_group[0] & same_group[1] & same_group[2], "left").select(
        "s.key", "s.item", "s.share", F.coalesce("t.asked", F.lit(0)).alias("n_slots"),
        F.coalesce(F.col("t.pairs") == F.col("t.asked"), F.lit(True)).alias("consistent"), F.coalesce("t.same", F.lit(True)).alias("verbatim"))
    best = both.where("consistent").groupBy("key", F.col("item.id").alias("item")).agg(F.max(F.struct("share", "verbatim", "n_slots")).alias("b"))
    return best.select(F.col("key.id").alias(id_col), F.col("key.t").alias("text_hash"), F.col("item").alias(item_col),
                       "b.share", "b.n_slots", "b.verbatim")


def without_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that leak no item."""
    found = stored(leaks(df, benchmark, id_col, text_col, item_col, item_text_col)
                   .select(F.col(id_col).alias("leak_id"), F.col("text_hash").alias("leak_text")).distinct(), "leaks")
    same = col(id_col).eqNullSafe(F.col("leak_id")) & (F.xxhash64(_text(text_col)) == F.col("leak_text"))
    return df.join(found, same, "left_anti")
