"""Raw tracker objects: concatenated-JSON decode (S05), the partitioned raw
zone (S07, S10, S11, S17), object listing / counting (S01-S04), backfill of
hours (S18), archive and restore (S08) and JSON object get/put (S09).

Raw objects are minute-sized text blobs, so one object is one row; the
repair is a chain of ``regexp_replace`` and the parse is ``try_parse_json``
(documents that can't be read yield no events, and their object is reported by
``corrupt_objects`` instead of failing the batch).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktrail.functions.dates import lit_ts
from sparktrail.schemas import JUNK_TAGS
from sparktrail.session import configured


def repair_text(text):
    """S05 repair: ``}{`` -> ``},{``; junk tags between / before / after
    documents removed; wrapped in ``[...]``."""
    t = F.regexp_replace(text, r"\}\{", "},{")
    for tag in JUNK_TAGS:
        q = re.escape(tag)
        t = F.regexp_replace(t, r"\}(" + q + r")+\{", "},{")
        t = F.regexp_replace(t, r"^(" + q + r")+\{", "{")
        t = F.regexp_replace(t, r"\}(" + q + r")+$", "}")
    return F.concat(F.lit("["), t, F.lit("]"))


def _between_documents() -> str:
    """Pattern of what lies between two documents: nothing, or a run of one junk tag."""
    runs = "|".join(f"(?:{re.escape(tag)})+" for tag in JUNK_TAGS)
    return r"(?<=\})(?:" + runs + r")?(?=\{)"


def decode_objects(objects: DataFrame, text_col: str = "text", keep=("path",)) -> DataFrame:
    """One row per document: (keep..., doc_pos, ev VARIANT).

    An object is cut between its documents and each is parsed once. Where that
    gives something unreadable (a text value holds ``}{``, documents come with
    commas, a document repeats a key), the object is repaired and read as one
    array; of one that isn't readable so either the readable documents are kept,
    and ``corrupt_objects`` reports it."""
    text = F.col(text_col)
    for tag in JUNK_TAGS:
        q = re.escape(tag)
        text = F.regexp_replace(F.regexp_replace(text, r"^(?:" + q + r")+\{", "{"), r"\}(?:" + q + r")+$", "}")
    # in brackets, as the parser reads one value and no further
    pieces = F.transform(F.split(text, _between_documents()), lambda doc: F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), doc, F.lit("]"))), "$", "array<variant>"))
    repaired = repair_text(F.col("_text"))
    one_by_one = F.transform(F.from_json(repaired, "array<string>"), lambda doc: F.try_parse_json(doc))
    as_array = F.coalesce(F.try_variant_get(F.try_parse_json(repaired), "$", "array<variant>"), one_by_one)
    cut = objects.select(*keep, F.col(text_col).alias("_text"), pieces.alias("_cut"))
    docs = F.when(F.forall("_cut", lambda d: d.isNotNull()), F.flatten("_cut")).otherwise(as_array)
    # outer: of an inner one the optimizer infers filters that decode the text again and again
    return (cut.select(*keep, docs.alias("_docs")).select(*keep, F.posexplode_outer("_docs").alias("doc_pos", "ev"))
            .where("ev IS NOT NULL"))


def corrupt_objects(objects: DataFrame, text_col: str = "text", keep=("path",)) -> DataFrame:
    """Objects whose repaired text is not a JSON array of readable documents."""
    parsed = F.try_parse_json(repair_text(F.col(text_col)))
    return objects.where(F.try_variant_get(parsed, "$", "array<variant>").isNull()).select(*keep)


#: Prefixes of an hour's objects: as the tracker writes them, and as Spark writes partitions.
TRACKER_LAYOUT, PARTITION_LAYOUT = "%Y/%m/%d/%H", "dt=%Y-%m-%d/hour=%-H"
_LISTING = "path string, modificationTime timestamp, length long"


def object_prefix(date, hour: int | None = None, layout: str = TRACKER_LAYOUT) -> str:
    """The prefix of a day's or an hour's objects."""
    from sparktrail.functions.dates import to_datetime
    at = to_datetime(date).replace(hour=hour or 0)
    return at.strftime(layout if hour is not None else layout.rsplit("/", 1)[0])


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def grouped_listing(spark: SparkSession):
    """Within, many folders are listed by a few tasks a core. By default each folder has a task of its own, which takes
    longer and sends the driver more than the listing itself."""
    return configured(spark, {_LISTING_TASKS: str(4 * spark.sparkContext.defaultParallelism)})


def list_objects(spark: SparkSession, root: str, prefixes: list[str] | None = None, glob: str | None = None,
                 modified_after: str | None = None, content: bool = False) -> DataFrame:
    """Objects under ``root``, or under some prefixes of it, as (path, modificationTime, length), and their
    content if asked for; without it nothing is read but the listing. Only the prefixes are listed; one that isn't
    there has no objects. ``glob`` is of the objects' names, ``modified_after`` a UTC time. Spark's scan passes over
    empty objects: where no content is asked for, these are added from the names that it listed (without a time)."""
    from sparktrail.streaming.store import path_exists
    root = root.rstrip("/")
    paths = [p for p in ([root] if prefixes is None else [f"{root}/{x}" for x in prefixes]) if path_exists(spark, p)]
    schema = _LISTING + (", content binary" if content else "")
    if not paths:
        return spark.createDataFrame([], schema)
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    with grouped_listing(spark):
        df = r.load(paths)
    if content:
        return df.select("path", "modificationTime", "length", "content")
    # nothing is read: a task for every few files would only send the driver its own report
    df = df.select("path", "modificationTime", "length").coalesce(4 * spark.sparkContext.defaultParallelism)
    names = spark.createDataFrame([(n,) for n in df.inputFiles()], "path string")
    plain = F.try_url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    names = names.select(F.regexp_replace(plain, "^([A-Za-z0-9+.-]+):/+", "$1:/").alias("path"))
    seen = df.select(F.regexp_replace("path", "^([A-Za-z0-9+.-]+):/+", "$1:/").alias("path"))
    empty = names.join(seen, "path", "left_anti").select("path", F.lit(None).cast("timestamp").alias("modificationTime"),
                                                         F.lit(0).cast("long").alias("length"))
    return df.unionByName(empty)


def day_objects(spark: SparkSession, root: str, date, layout: str = TRACKER_LAYOUT, **options) -> DataFrame:
    """Objects of a (UTC) day."""
    return list_objects(spark, root, [object_prefix(date, None, layout)], **options)


def hour_objects(spark: SparkSession, root: str, date, hour: int, layout: str = TRACKER_LAYOUT, **options) -> DataFrame:
    """Objects of a (UTC) hour."""
    return list_objects(spark, root, [object_prefix(date, hour, layout)], **options)


def latest_hour_objects(spark: SparkSession, root: str, as_of, layout: str = TRACKER_LAYOUT, **options) -> DataFrame:
    """Objects of the hour that ``as_of`` lies in."""
    from sparktrail.functions.dates import to_datetime
    return hour_objects(spark, root, as_of, to_datetime(as_of).hour, layout, **options)


def latest_minute_objects(spark: SparkSession, root: str, as_of, name: str = "*%Y-%m-%d-%H-%M*",
                          layout: str = TRACKER_LAYOUT, **options) -> DataFrame:
    """Objects named by the minute before ``as_of``, in that minute's hour."""
    import datetime as _dt

    from sparktrail.functions.dates import to_datetime
    at = to_datetime(as_of) - _dt.timedelta(minutes=1)
    return hour_objects(spark, root, at, at.hour, layout, glob=at.strftime(name), **options)


def object_texts(objects: DataFrame) -> DataFrame:
    """(path, length, text) of objects that were listed with their content."""
    return objects.select("path", "length", F.decode(F.col("content"), "UTF-8").alias("text"))


def count_objects(objects: DataFrame, *by) -> DataFrame:
    """Total and non-empty object counts."""
    return objects.groupBy(*by).agg(F.count(F.lit(1)).alias("n_objects"),
                                    F.sum((F.col("length") > 0).cast("int")).cast("bigint").alias("n_non_empty"))


def criteria_filter(events: DataFrame, criteria: dict) -> DataFrame:
    """for each key it must be present; when a value is given it must
    equal it (presence is true for a JSON null, as in the reference)."""
    df = events
    for k, v in criteria.items():
        path = f"$.{k}"
        present = F.try_variant_get(F.col("ev"), path, "variant").isNotNull()
        df = df.where(present)
        if v is not None:
            df = df.where(F.try_variant_get(F.col("ev"), path, "string") == F.lit(str(v)))
    return df


def fuzzy_filter(events: DataFrame, criteria: dict) -> DataFrame:
    """``value in ev[key]`` - substring for strings, membership for
    lists."""
    df = events
    for k, v in criteria.items():
        path = f"$.{k}"
        s = F.try_variant_get(F.col("ev"), path, "string")
        arr = F.try_variant_get(F.col("ev"), path, "array<string>")
        df = df.where(F.when(arr.isNotNull(), F.array_contains(arr, F.lit(str(v))))
                       .otherwise(F.coalesce(F.instr(s, str(v)) > 0, F.lit(False))))
    return df


def with_event_fields(events: DataFrame) -> DataFrame:
    """Promote web_id, event_type, ts_ms and the UTC partition columns."""
    ms = F.try_variant_get(F.col("ev"), "$.timestamp", "bigint")
    from sparktrail.functions.dates import ms_to_local
    utc = ms_to_local(ms, 0)
    return events.select("*",
                         F.try_variant_get(F.col("ev"), "$.web_id", "string").alias("web_id"),
                         F.try_variant_get(F.col("ev"), "$.event_type", "string").alias("event_type"),
                         ms.alias("ts_ms"), F.to_date(utc).alias("dt"), F.hour(utc).alias("hour"))


def land_raw(events: DataFrame, root: str) -> None:
    """Write decoded events to the raw zone, partitioned by UTC (dt,
    hour); re-landing an hour overwrites only that hour."""
    (events.withColumn("ev_json", F.to_json(F.col("ev"))).drop("ev")
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("dt", "hour").parquet(root))


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """Raw-zone scan; ``ev`` restored as VARIANT."""
    df = spark.read.parquet(root)
    return df.withColumn("ev", F.parse_json(F.col("ev_json"))).drop("ev_json")


def hour_slice(raw: DataFrame, date, hour: int, utc: int = 8) -> DataFrame:
    """The raw hour of local (date, hour) at UTC+utc: partition filter
    on the shifted UTC hour (missing hour -> empty)."""
    from sparktrail.functions.dates import to_datetime
    import datetime as _dt
    t = to_datetime(date) + _dt.timedelta(hours=hour - utc)
    return raw.where((F.col("dt") == F.lit(t.date())) & (F.col("hour") == F.lit(t.hour)))


def local_day(raw: DataFrame, date_start, date_end=None, utc: int = 8) -> DataFrame:
    """Local days [start, end] = UTC hours from start - utc to end + 24 - utc."""
    from sparktrail.functions.dates import to_datetime
    import datetime as _dt
    s = to_datetime(date_start) - _dt.timedelta(hours=utc)
    e = to_datetime(date_end or date_start) + _dt.timedelta(hours=24 - utc)
    ts = F.timestamp_add("HOUR", F.col("hour"), F.col("dt").cast("timestamp_ntz"))
    return raw.where((F.col("dt") >= F.lit(s.date())) & (F.col("dt") <= F.lit(e.date()))
                     & (ts >= lit_ts(s)) & (ts < lit_ts(e)))


def retain(raw: DataFrame, as_of, n_days: int = 30) -> DataFrame:
    """The raw zone without days older than ``n_days`` before as_of, as
    a view (``drop_expired`` deletes them)."""
    from sparktrail.functions.dates import lit_date
    return raw.where(F.col("dt") >= F.date_sub(lit_date(as_of), n_days))


def drop_expired(spark: SparkSession, root: str, as_of, n_days: int = 30) -> int:
    """Delete the raw zone's ``dt=`` folders of days more than ``n_days``
    before as_of; returns how many. Works on any file system Spark can write."""
    import datetime as _dt

    from sparktrail.functions.dates import to_datetime
    oldest = (to_datetime(as_of) - _dt.timedelta(days=n_days)).date().isoformat()
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(top)]
    expired = [p for p in names if p.getName().startswith("dt=") and p.getName()[3:] < oldest]
    for path in expired:
        fs.delete(path, True)
    return len(expired)


def hour_range(spark: SparkSession, start, end) -> DataFrame:
    """The (dt, hour) partitions of a backfill range, inclusive."""
    return spark.range(1).select(F.explode(F.sequence(lit_ts(start), lit_ts(end),
                                                      F.expr("INTERVAL 1 HOUR"))).alias("h")) \
                .select(F.to_date("h").alias("dt"), F.hour("h").alias("hour"))


def hours_done(spark: SparkSession, manifest: str) -> DataFrame:
    """(dt, hour, n_events): the hours that backfills have landed."""
    from sparktrail.streaming.store import path_exists
    if not path_exists(spark, manifest):
        return spark.createDataFrame([], "dt date, hour int, n_events long")
    return spark.read.schema("n_events long, dt date, hour int").parquet(manifest).select("dt", "hour", "n_events")


def backfill(spark: SparkSession, objects_root: str, raw_root: str, manifest: str, start, end,
             criteria: dict | None = None, layout: str = TRACKER_LAYOUT, again: bool = False) -> DataFrame:
    """Land the hours from ``start`` to ``end`` that are not in the manifest yet (all of them, ``again``).

    The hours' objects are read in one job and land in the raw zone under the
    hour whose prefix they have; then the hours are noted with their events, an
    hour without objects with 0. A run that fails notes nothing, and the next one
    writes the same hours over. Returns the hours of this run."""
    import datetime as _dt

    asked = hour_range(spark, start, end)
    if not again:
        asked = asked.join(F.broadcast(hours_done(spark, manifest)), ["dt", "hour"], "left_anti")
    hours = [(r.dt, r.hour) for r in asked.collect()]  # of the range: one row per hour
    todo = spark.createDataFrame(hours, "dt date, hour int")
    if not hours:
        return todo.withColumn("n_events", F.lit(0).cast("long"))
    named = {h: object_prefix(_dt.datetime.combine(*h[:1], _dt.time()), h[1], layout) for h in hours}
    prefix = spark.createDataFrame([(f"/{p}/", *h) for h, p in named.items()], "prefix string, dt date, hour int")
    objects = object_texts(list_objects(spark, objects_root, list(named.values()), content=True))
    depth = len(layout.split("/"))
    below = F.substring(F.col("path"), F.instr("path", objects_root.rstrip("/")) + len(objects_root.rstrip("/")), 1 << 20)
    own = F.concat(F.lit("/"), F.array_join(F.slice(F.split(below, "/"), 2, depth), "/"), F.lit("/"))
    placed = objects.withColumn("prefix", own).join(F.broadcast(prefix), "prefix")
    events = decode_objects(placed, keep=("dt", "hour"))
    if criteria:
        events = criteria_filter(events, criteria)
    land_raw(events.drop("doc_pos"), raw_root)
    landed = read_raw_table(spark, raw_root).groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n_events"))
    counts = todo.join(landed, ["dt", "hour"], "left").select(
        "dt", "hour", F.coalesce("n_events", F.lit(0)).alias("n_events"))
    (counts.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "hour").parquet(manifest))
    return hours_done(spark, manifest).join(F.broadcast(todo), ["dt", "hour"], "left_semi")


def read_raw_table(spark: SparkSession, root: str) -> DataFrame:
    """The raw zone as stored; empty before anything landed."""
    from sparktrail.streaming.store import path_exists
    schema = "ev_json string, dt date, hour int"
    return spark.read.schema(schema).parquet(root) if path_exists(spark, root) else spark.createDataFrame([], schema)


def archive(df: DataFrame, target: str, partition_by=("dt", "hour")) -> None:
    """Copy a raw-zone slice to another root (object store)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(target)


def restore(spark: SparkSession, archive_root: str, target: str, date_start, date_end=None) -> DataFrame:
    """Copy archived (UTC) days back, over what the target has of them, and compare both: (dt, hour, n_events) of
    what was restored; an error if an hour differs in rows or contents."""
    from sparktrail.functions.dates import lit_date
    days = F.col("dt").between(lit_date(date_start), lit_date(date_end or date_start))
    archive(read_raw_table(spark, archive_root).where(days), target)
    marks = [F.count(F.lit(1)).alias("n_events"), F.sum(F.xxhash64("ev_json").cast("decimal(38,0)")).alias("mark")]
    kept, back = (read_raw_table(spark, root).where(days).groupBy("dt", "hour").agg(*marks)
                  for root in (archive_root, target))
    wrong = kept.join(back, ["dt", "hour", "n_events", "mark"], "left_anti").count()
    if wrong:
        raise RuntimeError(f"{wrong} restored hours differ from the archive")
    return kept.drop("mark")


def json_put(df: DataFrame, path: str) -> None:
    """S09 put."""
    df.write.mode("overwrite").json(path)


def json_get(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """S09 get; an empty table where there is nothing (``schema`` is needed then)."""
    from sparktrail.streaming.store import path_exists
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)
