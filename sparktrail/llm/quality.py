"""Quality rules with thresholds from mergeable quantile sketches.

Each text is measured once (words, symbols, repeated lines and repeated
three-word windows).  Each measure, as a whole number, goes into a sketch per
language and source: counts of buckets whose width is a fixed share of their
value (1/32).  Such sketches merge by adding counts, so they are plain
aggregates that don't depend on how the rows are dealt out, and a source that
holds a third of all rows is summed before the shuffle.  From the sketch's
quartiles come fences per language and source,

    high = q3 + 3 * max(q3 - q1, slack),    low = q1 - 3 * max(q3 - q1, slack)

which replace fixed cutoffs.  A group with fewer than ``MIN_GROUP`` texts takes
the merged sketch of its language, and a language with fewer that of all rows.
The texts are then joined with the fences of their group and filtered.

Only DataFrame functions are used.  Measures are written to the shared folder
once; sketches and verdicts read them there.  The fences have a row for each
language and source and are joined by size: Spark broadcasts them only if their
file is below ``spark.sql.autoBroadcastJoinThreshold``, and else sorts, with
skewed groups split.

Edge cases: a null or empty text has no words and fails; a null language or
source is a group like any other; repeated rows count each time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, col, packed, stored, unpacked

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Texts that a group's own sketch must have seen.
MIN_GROUP = 50
#: Measures: name -> (least distance that counts as spread, whether low values fail too).  All are whole numbers:
#: ten-thousandths of the characters, lines or words, and hundredths of a character a word.
MEASURES = {
    "symbol_share": (100, False),
    "dup_line_share": (1500, False),
    "repeat_share": (1000, False),
    "word_size": (50, True),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the windows' hashes in text order."""
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # bound once as an element, so that it isn't sorted again for each comparison
    places = F.transform(F.array(by_hash), lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))), lambda x: x["i"])))
    return F.aggregate(
        F.get(places, 0), F.struct(F.lit(0).cast("long").alias("c"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["c"] + F.least(F.lit(3), p - a["last"])).alias("c"), p.alias("last")),
        lambda a: a["c"])


def measured(df: DataFrame, text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """``keep`` (all columns, as the struct ``row``, if not given) with the counts and measures of each text."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    keep = packed(df) if keep is None else keep.alias("row")
    rows = df.select(keep, text.alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    rows = rows.select("row", F.array_remove(F.split("t", f"[{SPACE}]+", -1), "").alias("w"), lines.alias("lines"))
    n = F.size("w")
    windows = F.transform(F.slice("w", F.lit(1), F.greatest(n - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    rows = rows.select("row", "lines", n.cast("long").alias("n_words"), F.array_join("w", "").alias("joined"),
                       windows.alias("g"))
    rows = rows.select(
        "row", "n_words", F.char_length("joined").cast("long").alias("word_chars"),
        (F.char_length("joined") - F.char_length(F.regexp_replace("joined", r"[#*$%&|<>]+", ""))).cast("long")
        .alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("g")) < F.size("g"), _covered(F.col("g"))).otherwise(F.lit(0))
        .cast("long").alias("n_repeat_words"))
    share = lambda a, b, by: F.when(F.col(b) > 0, F.floor(F.col(a) * by / F.col(b))).otherwise(0).cast("long")
    return rows.select(
        "*", share("n_symbols", "word_chars", 10_000).alias("symbol_share"),
        share("n_dup_lines", "n_lines", 10_000).alias("dup_line_share"),
        share("n_repeat_words", "n_words", 10_000).alias("repeat_share"),
        share("word_chars", "n_words", 100).alias("word_size"))


def bucket(value: Column) -> Column:
    """The lower edge of a value's sketch bucket: exact below 64, then 32 buckets for each power of two."""
    width = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - 6, F.lit(0))).cast("long")
    return (value - F.pmod(value, width)).cast("long")


def sketches(rows: DataFrame, groups: list[str], measures=MEASURES) -> DataFrame:
    """(groups, measure, bucket, n): mergeable counts; ``sketches`` of a part add up to those of the whole."""
    each = rows.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in measures])).alias("x"))
    return each.groupBy(*groups, "x.measure", "x.bucket").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(sketch: DataFrame, groups: list[str], suffix: str) -> DataFrame:
    """Rows seen and quartiles of each sketch; a group has as many rows as buckets, a few hundred at most."""
    sums = sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*groups, "measure")
    run = sums.select("*", F.sum("n").over(w.orderBy("bucket")).alias("upto"), F.sum("n").over(w).alias("all"))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("bucket")))
    return run.groupBy(*groups, "measure").agg(
        F.max("all").alias(f"n{suffix}"), at(1).alias(f"q1{suffix}"), at(3).alias(f"q3{suffix}"))


def fences(sketch: DataFrame, min_group: int = MIN_GROUP, measures=MEASURES) -> DataFrame:
    """(lang, source, high_* and low_*): one row for each language and source."""
    own = _quartiles(sketch, ["lang", "source"], "").alias("o")
    lang = _quartiles(sketch, ["lang"], "_l").withColumnsRenamed({"lang": "lang_l", "measure": "m_l"})
    every = _quartiles(sketch, [], "_e").withColumnRenamed("measure", "m_e")
    all_ = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_l")) & (F.col("measure") == F.col("m_l"))).join(
        every, F.col("measure") == F.col("m_e"))
    pick = lambda q: F.when(F.col("n") >= min_group, F.col(q)).when(
        F.col("n_l") >= min_group, F.col(f"{q}_l")).otherwise(F.col(f"{q}_e"))
    all_ = all_.select("lang", "source", "measure", pick("q1").alias("q1"), pick("q3").alias("q3"))
    of = lambda m, x: F.max(F.when(F.col("measure") == m, x))
    spread = lambda slack: F.greatest(F.col("q3") - F.col("q1"), F.lit(slack))
    return all_.groupBy("lang", "source").agg(
        *[of(m, F.col("q3") + 3 * spread(s)).alias(f"high_{m}") for m, (s, _) in measures.items()],
        *[of(m, F.col("q1") - 3 * spread(s)).alias(f"low_{m}") for m, (s, two) in measures.items() if two])


def judged(rows: DataFrame, limits: DataFrame, measures=MEASURES) -> DataFrame:
    """``rows`` (measured, with lang and source) with base_failed and kept."""
    limits = limits.withColumnsRenamed({"lang": "lang_", "source": "source_"})
    both = rows.join(limits, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")),
                     "left")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    outside = reduce(Column.__or__, [F.col(m) > F.col(f"high_{m}") for m in measures] + [
        F.col(m) < F.col(f"low_{m}") for m, (_, two) in measures.items() if two])
    return both.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False)))


def _stored_measures(df: DataFrame, text_col: str, lang_col: str, source_col: str, keep: Column | None) -> DataFrame:
    keep = packed(df) if keep is None else keep
    groups = F.struct(keep.alias("row"), col(lang_col).alias("lang"), col(source_col).alias("source"))
    return stored(measured(df, text_col, groups).select(
        F.col("row.row").alias("row"), F.col("row.lang").alias("lang"), F.col("row.source").alias("source"),
        *COUNTS, *MEASURES), "measures")


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """One row per row of ``df``: the id, the counts, base_failed and kept."""
    rows = _stored_measures(df, text_col, lang_col, source_col, col(id_col))
    limits = stored(fences(sketches(rows, ["lang", "source"])), "fences")
    return judged(rows, limits).select(F.col("row").alias(id_col), *COUNTS, "base_failed", "kept")


def keep_good(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` that are kept."""
    rows = _stored_measures(df, text_col, lang_col, source_col, None)
    limits = stored(fences(sketches(rows, ["lang", "source"])), "fences")
    return unpacked(judged(rows, limits).where("kept"), df)
