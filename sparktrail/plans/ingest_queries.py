"""Queries of the ingest: streams whose batches overlap, statistics kept up to
date, object listings, backfill, archive. All objects are written from the
``events`` table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparktrail import schemas as S
from sparktrail.operators import stats as ST
from sparktrail.plans import adapters as A
from sparktrail.plans import oracle as O
from sparktrail.plans import raw_adapter as RA
from sparktrail.plans.registry import _COUPON_SQL, _TRACKER_SQL, register
from sparktrail.plans.sizing import shuffled_for
from sparktrail.session import configured, scratch_path
from sparktrail.sources import raw as RAW

#: Objects of some MB that a task puts together at a time; more are sorted, on disk where they are many.
FEW_OBJECTS = {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8"}
HOURLY, DAILY = "yyyy/MM/dd/HH", "yyyy/MM/dd/'00'"  # times that objects are named by


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _both_documents(ev):
    return RA.raw_documents(ev).unionByName(RA.second_documents(ev))


def _batches():
    """Three batches of event ids: thirds that interleave in time, so that the second and third are full of late events,
    which also bring again what came before, some of it changed (device 7)."""
    i = F.col("event_id")
    return [i % 3 == 0, (i % 3 == 1) | (i % 6 == 0), (i % 3 == 2) | (i % 6 == 0) | ((i % 3 == 1) & (i % 4 == 0))]


def _stream(spark, sf_dir, types, batches, statistics=False):
    """The clean store after runs of the stream, each over one more folder of objects, one file each."""
    from sparktrail.streaming.ingest import start_ingest
    from sparktrail.streaming.store import CleanStore
    base = _folder(spark, "overlap")
    ev = A.base_events(spark, sf_dir).withColumn("event_id", F.col("ord"))
    for number, chosen in enumerate(batches):
        def documents(ev, again=number > 0):
            docs = _both_documents(ev)
            changed = F.regexp_replace("doc", '"dv":[0-9]+', '"dv":7')
            return docs.withColumn("doc", F.when((F.col("event_id") % 6 == 0) & F.lit(again), changed).otherwise(F.col("doc")))
        some = ev.where(chosen)
        rows = some.count()
        with configured(spark, FEW_OBJECTS), shuffled_for(spark, rows):
            RA.write_objects(RA.raw_objects(RA.filled_parts(some, DAILY, RA.IDS_PER_FILE), documents, pattern=DAILY, rows=rows),
                             f"{base}/objects/run={number}")
        with RAW.grouped_listing(spark):  # each object lies in a folder of its own
            q = start_ingest(spark, f"{base}/objects", f"{base}/_checkpoint", f"{base}/clean", types, statistics=statistics,
                             slot_hours=24)
            q.awaitTermination()
    return CleanStore(spark, f"{base}/clean", 24)


_ARRIVAL = ("CASE WHEN ord % 6 = 0 OR ord % 3 = 2 OR (ord % 3 = 1 AND ord % 4 = 0) THEN 2 ELSE ord % 3 END")
# the last row of each key, in the order in which the batches bring them
_DEDUP_LOAD = (f"SELECT * REPLACE (CASE WHEN ord % 6 = 0 THEN '7' ELSE device END AS device) FROM ({RA.expected_sql('load')}) x "
               f"QUALIFY row_number() OVER (PARTITION BY {', '.join(S.unique_keys('load'))} ORDER BY {_ARRIVAL} DESC, ord DESC) = 1")


@register("stream_overlapping_load", O.prefix() + "\n" + _DEDUP_LOAD)
def q_stream_overlapping_load(spark, sf_dir):
    """Load events of overlapping batches, read as whole objects; each key once, the last row."""
    store = _stream(spark, sf_dir, ["load"], _batches())
    schema = spark.createDataFrame([], "ord long, " + ", ".join(
        f"`{c}` string" for c in [c for _, c in S.UNIVERSAL_KEYS] + [c for _, c in S.LOAD_KEYS]) + ", date_time timestamp_ntz").schema
    return store.current("load", schema).drop("date", "slot")


_STREAM_TYPES = ["load", "leave", "acceptCoupon", "discardCoupon"]


def _clean_sql(event_type: str) -> str:
    second = event_type in ("sendCoupon", "discardCoupon")
    return RA.second_sql(event_type) if second else RA.expected_sql(event_type)


def _stream_statistics_sql() -> str:
    ctes = []
    for t in _STREAM_TYPES:
        pb = "CAST(is_purchased_before AS INTEGER)" if t in ST.TRACKER_TYPES else "0"
        ctes.append(f"k_{t} AS (SELECT web_id, uuid, session_id, date_time, {pb} AS is_purchased_before FROM ({_clean_sql(t)}) x "
                    "GROUP BY ALL)")  # the keys, once each
    def of(t):
        return f"SELECT * FROM k_{t}" if t in _STREAM_TYPES else "SELECT * FROM k_load WHERE false"
    ctes += [f"t_{t} AS ({of(t)})" for t in ST.TRACKER_TYPES]
    ctes += [f"{n} AS ({of(t)})" for n, t in (("send", "sendCoupon"), ("accept", "acceptCoupon"), ("discard", "discardCoupon"))]
    return (f"WITH {O.EV}, {', '.join(ctes)}, tr AS ({_TRACKER_SQL}), co AS ({_COUPON_SQL}) "
            "SELECT * FROM tr FULL OUTER JOIN co USING (web_id, date)")


@register("stream_statistics", _stream_statistics_sql())
def q_stream_statistics(spark, sf_dir):
    """The statistics that the stream keeps, after overlapping batches of late events."""
    from sparktrail.streaming.ingest import STATISTICS
    i = F.col("event_id")  # two halves that interleave in time and overlap
    store = _stream(spark, sf_dir, _STREAM_TYPES, [i % 2 == 0, (i % 2 == 1) | (i % 6 == 0)], statistics=True)
    empty = spark.createDataFrame([], "web_id string, uuid string, session_id string, date date, etype string, n long, pb int")
    return store.current(STATISTICS, ST.merged_statistics(empty).schema).drop("slot")


# ------------------------------------------------------------ objects
_OBJECTS = ("SELECT CAST(ts AS DATE) AS dt, CAST(date_part('hour', ts) AS INTEGER) AS hour, "
            f"ord // {RA.IDS_PER_OBJECT} AS part, COUNT(*) AS n FROM ev GROUP BY ALL")


def _objects(spark, sf_dir) -> str:
    root = _folder(spark, "objects")
    RA.write_objects(RA.raw_objects(A.base_events(spark, sf_dir), pattern=HOURLY), root)
    return root


def _by_hour(objects):
    hour = F.regexp_extract("path", "hour=([0-9]+)", 1).cast("int").alias("hour")
    return RAW.count_objects(objects, F.to_date(F.regexp_extract("path", "dt=([0-9-]+)", 1)).alias("dt"), hour)


@register("objects_listed", O.prefix() + f""", o AS ({_OBJECTS}), latest AS (SELECT max(ts) AS t FROM ev), s AS (
SELECT 'all' AS scan, * FROM o UNION ALL SELECT 'day', o.* FROM o, latest WHERE dt = CAST(t AS DATE)
UNION ALL SELECT 'hour', o.* FROM o, latest WHERE dt = CAST(t AS DATE) AND hour = date_part('hour', t)
UNION ALL SELECT 'name', o.* FROM o WHERE part % 10 = 0)
SELECT scan, dt, hour, COUNT(*) AS n_objects, CAST(COUNT(*) AS BIGINT) AS n_non_empty FROM s GROUP BY ALL""")
def q_objects_listed(spark, sf_dir):
    """Objects of all hours, of the latest day, of the latest hour, and by name, counted without being read."""
    root = _objects(spark, sf_dir)
    latest = A.base_events(spark, sf_dir).agg(F.max("ts")).first()[0]
    layout = RAW.PARTITION_LAYOUT
    scans = {"all": RAW.list_objects(spark, root), "day": RAW.day_objects(spark, root, latest, layout),
             "hour": RAW.latest_hour_objects(spark, root, latest, layout)}
    name = F.regexp_extract("path", "object-([0-9]+)", 1).cast("long")
    scans["name"] = scans["all"].where(name % 10 == 0)
    parts = [_by_hour(df).select(F.lit(k).alias("scan"), "*") for k, df in scans.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("backfilled_hours", O.prefix() + """, h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-05 00:00:00',
  TIMESTAMP '2024-01-07 23:00:00', INTERVAL 1 HOUR)) AS h)
SELECT CAST(h AS DATE) AS dt, CAST(date_part('hour', h) AS INTEGER) AS hour, COUNT(ord) AS n_events, COUNT(ord) AS n_landed
FROM h LEFT JOIN ev ON date_trunc('hour', ev.ts) = h GROUP BY h""")
def q_backfilled_hours(spark, sf_dir):
    """Two backfills whose ranges overlap land each hour once; a day archived, dropped and restored."""
    root, raw, done, kept = _objects(spark, sf_dir), *(_folder(spark, n) for n in ("raw", "done", "archive"))
    for start, end in (("2024-01-05 00:00:00", "2024-01-06 12:00:00"), ("2024-01-06 00:00:00", "2024-01-07 23:00:00")):
        hours = RAW.backfill(spark, root, raw, done, start, end, {"web_id": None}, RAW.PARTITION_LAYOUT)
    RAW.archive(RAW.read_raw_table(spark, raw), kept)
    RAW.drop_expired(spark, raw, "2024-01-07", 0)
    RAW.restore(spark, kept, raw, "2024-01-05", "2024-01-06")
    landed = RAW.read_raw_table(spark, raw).groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n_landed"))
    return RAW.hours_done(spark, done).join(landed, ["dt", "hour"], "left").withColumn(
        "n_landed", F.coalesce("n_landed", F.lit(0)))


@register("raw_hour_slice", O.prefix() + """SELECT web_id, CAST(COUNT(*) AS BIGINT) AS n FROM ev
WHERE ts >= TIMESTAMP '2024-01-05 20:00:00' AND ts < TIMESTAMP '2024-01-05 21:00:00' GROUP BY web_id""")
def q_raw_hour_slice(spark, sf_dir):
    """The raw zone's hour 4 of the local day 2024-01-06 (UTC+8), from landed objects."""
    raw = _folder(spark, "raw")
    docs = RAW.decode_objects(RA.raw_objects(A.base_events(spark, sf_dir), pattern=HOURLY))
    RAW.land_raw(RAW.with_event_fields(docs).select("ev", "dt", "hour"), raw)
    hour = RAW.hour_slice(RAW.read_raw(spark, raw), "2024-01-06", 4)
    return hour.groupBy(F.try_variant_get("ev", "$.web_id", "string").alias("web_id")).agg(
        F.count(F.lit(1)).alias("n"))


@register("json_objects", O.prefix() + "SELECT web_id, CAST(date_time AS DATE) AS date, COUNT(*) AS n FROM ev GROUP BY ALL")
def q_json_objects(spark, sf_dir):
    """A table put as JSON objects and got again."""
    path = _folder(spark, "json")
    ev = A.base_events(spark, sf_dir)
    RAW.json_put(ev.groupBy("web_id", F.to_date("date_time").alias("date")).agg(F.count(F.lit(1)).alias("n")), path)
    return RAW.json_get(spark, path, "web_id string, date date, n long")
