"""Merging batches into clean tables, kept statistics, listings, backfill, archive."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

TYPES = ["load", "leave"]


def document(i, second, kind="load", dv="1", uuid="u1", session="s1", before="0"):
    at = int((dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)).timestamp() * 1000)
    body = {"dv": dv, "s_id": session, "i_pb": before, "l_c": "1"}
    doc = {"_ord": i, "web_id": "w", "uuid": uuid, "ga_id": "g", "fb_id": "f", "timestamp": at, "event_type": kind}
    doc["load" if kind == "load" else "record_user"] = body
    return json.dumps(doc)


def objects(spark, named):
    return spark.createDataFrame([(p, "".join(docs)) for p, docs in named.items()], "path string, text string")


def rows_of(spark, root, name="load"):
    from sparktrail.streaming.store import CleanStore
    store = CleanStore(spark, root, 6)
    schema = "ord long, device string, uuid string, session_id string, date_time timestamp_ntz"
    return store.current(name, spark.createDataFrame([], schema).schema)


def statistics(spark, root):
    from sparktrail.streaming.store import CleanStore
    schema = "web_id string, n_events_load long, n_uuid_load long, n_sessions_load long, n_events_leave long, " \
             "n_uuid_load_purchased_before long, n_events_acceptCoupon long"
    df = CleanStore(spark, root, 6).current("statistics", spark.createDataFrame([], schema).schema)
    return {str(r.date): (r.n_events_load, r.n_uuid_load, r.n_sessions_load, r.n_events_leave, r.n_uuid_load_purchased_before)
            for r in df.collect()}


def run(spark, root, number, named, **options):
    from sparktrail.streaming.ingest import process_batch
    process_batch(objects(spark, named), number, root, TYPES, statistics=True, slot_hours=6, **options)


@pytest.fixture(scope="module")
def batches(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clean"))
    day = 86_400
    first = {"o1": [document(1, 10), document(2, 20), document(3, 20, dv="2")], "o2": [document(4, day, uuid="u2", session="s2")]}
    run(spark, root, 0, first)
    state = [({r.ord: r.device for r in rows_of(spark, root).collect()}, statistics(spark, root))]
    again = {**first, "o3": [document(5, 10, dv="9"), document(6, 30, kind="leave"), document(7, 3 * 3600, uuid="u3", before="1")]}
    run(spark, root, 1, again)
    state.append(({r.ord: r.device for r in rows_of(spark, root).collect()}, statistics(spark, root)))
    return root, state, again


def test_each_key_once_the_last_row(batches):
    _, (first, second), _ = batches
    assert first[0] == {1: "1", 3: "2", 4: "1"}  # of one batch, the later row of a key
    assert second[0] == {5: "9", 3: "2", 4: "1", 7: "1"}  # the same objects again, and a changed row


def test_statistics_follow_late_events(batches):
    _, (first, second), _ = batches
    assert first[1] == {"2024-01-05": (2, 1, 1, 0, 0), "2024-01-06": (1, 1, 1, 0, 0)}
    assert second[1] == {"2024-01-05": (3, 2, 2, 1, 1), "2024-01-06": (1, 1, 1, 0, 0)}


def test_a_batch_again_and_a_batch_that_broke_off(spark, batches, monkeypatch):
    from sparktrail.streaming.store import CleanStore
    root, (_, second), again = batches
    run(spark, root, 1, again)
    assert {r.ord: r.device for r in rows_of(spark, root).collect()} == second[0] and statistics(spark, root) == second[1]

    def broken(*_):
        raise OSError("no more")

    late = {"o9": [document(8, 40, uuid="u9")]}
    with monkeypatch.context() as m:
        m.setattr(CleanStore, "commit", broken)
        with pytest.raises(OSError):
            run(spark, root, 2, late)
    assert 8 not in {r.ord for r in rows_of(spark, root).collect()} and statistics(spark, root) == second[1]
    run(spark, root, 2, late)
    assert 8 in {r.ord for r in rows_of(spark, root).collect()} and statistics(spark, root)["2024-01-05"][0] == 4
    assert CleanStore(spark, root, 6).vacuum(["load"], keep=0) > 0 and statistics(spark, root)["2024-01-05"][0] == 4
    assert 8 in {r.ord for r in rows_of(spark, root).collect()}


def test_only_touched_days_are_read(spark, batches):
    from sparktrail.streaming.store import CleanStore
    schema = spark.createDataFrame([], "ord long").schema
    some = CleanStore(spark, batches[0], 6).current("load", schema, ["2024-01-06", "2030-01-01"])
    files = {f.split("date=")[1][:10] for f in some.inputFiles() if "/load/" in f}
    assert files == {"2024-01-06"} and {str(r.date) for r in some.collect()} == {"2024-01-06"}


def test_documents_cut_once(spark):
    from sparktrail.sources.raw import decode_objects
    texts = {"plain": '{"a":1}{"a":2}', "junk": '"landing"{"a":1}"landing""landing"{"a":2}"]"{"a":3}"]"', "inside": '{"a":"x}{y"}{"a":2}',
             "commas": '{"a":1},{"a":2}', "twice": '{"a":1}{"b":1,"b":2}{"a":3}', "empty": "", "nested": '{"a":[{"b":1},{"b":2}]}{"a":2}'}
    df = spark.createDataFrame(list(texts.items()), "path string, text string")
    got = {}
    for r in decode_objects(df).select("path", "doc_pos", F.to_json("ev").alias("t")).orderBy("path", "doc_pos").collect():
        got.setdefault(r.path, []).append(r.t)
    assert got == {"plain": ['{"a":1}', '{"a":2}'], "junk": ['{"a":1}', '{"a":2}', '{"a":3}'], "inside": ['{"a":"x},{y"}', '{"a":2}'],
                   "commas": ['{"a":1}', '{"a":2}'], "twice": ['{"a":1}', '{"a":3}'], "nested": ['{"a":[{"b":1},{"b":2}]}', '{"a":2}']}


@pytest.fixture()
def bucket(tmp_path):
    for hour, minute, text in ((3, 58, '{"web_id":"w"}'), (3, 59, ""), (4, 1, '{"web_id":"w"}{"web_id":"v"}'), (4, 2, '{"x":1}')):
        folder = tmp_path / f"2024/01/05/{hour:02d}"
        os.makedirs(folder, exist_ok=True)
        (folder / f"tracker-2-2024-01-05-{hour:02d}-{minute:02d}-1").write_text(text)
    return str(tmp_path)


def test_listing(spark, bucket):
    from sparktrail.sources import raw as RAW
    def count(df):
        r = RAW.count_objects(df).first()
        return r.n_objects, r.n_non_empty or 0
    assert count(RAW.list_objects(spark, bucket)) == count(RAW.day_objects(spark, bucket, "2024-01-05")) == (4, 3)
    assert count(RAW.hour_objects(spark, bucket, "2024-01-05", 3)) == (2, 1)
    assert count(RAW.hour_objects(spark, bucket, "2024-01-05", 5)) == count(RAW.day_objects(spark, bucket, "2024-01-06")) == (0, 0)
    as_of = dt.datetime(2024, 1, 5, 4, 2, 30)
    assert count(RAW.latest_hour_objects(spark, bucket, as_of)) == (2, 2)
    assert count(RAW.latest_minute_objects(spark, bucket, as_of)) == (1, 1)
    assert count(RAW.latest_minute_objects(spark, bucket, dt.datetime(2024, 1, 5, 4, 0, 5))) == (1, 0)  # 03:59, in its own hour
    assert count(RAW.list_objects(spark, bucket, modified_after="2100-01-01T00:00:00")) == (0, 0)
    assert "content" not in RAW.list_objects(spark, bucket).columns


def test_backfill_lands_each_hour_once(spark, bucket, tmp_path):
    from sparktrail.sources import raw as RAW
    raw, done, kept = (str(tmp_path / n) for n in ("raw", "done", "kept"))
    first = RAW.backfill(spark, bucket, raw, done, "2024-01-05 02:00:00", "2024-01-05 03:00:00", {"web_id": None})
    assert {(r.hour, r.n_events) for r in first.collect()} == {(2, 0), (3, 1)}
    second = RAW.backfill(spark, bucket, raw, done, "2024-01-05 03:00:00", "2024-01-05 05:00:00", {"web_id": None})
    assert {(r.hour, r.n_events) for r in second.collect()} == {(4, 2), (5, 0)}
    assert RAW.backfill(spark, bucket, raw, done, "2024-01-05 03:00:00", "2024-01-05 05:00:00").count() == 0
    again = RAW.backfill(spark, bucket, raw, done, "2024-01-05 04:00:00", "2024-01-05 04:00:00", again=True)
    assert {(r.hour, r.n_events) for r in again.collect()} == {(4, 3)}
    assert RAW.read_raw_table(spark, raw).count() == 4 and RAW.hours_done(spark, done).count() == 4
    RAW.archive(RAW.read_raw_table(spark, raw), kept)
    assert RAW.drop_expired(spark, raw, "2024-01-07", 0) == 1 and RAW.read_raw_table(spark, raw).count() == 0
    back = RAW.restore(spark, kept, raw, "2024-01-05")
    assert {(r.hour, r.n_events) for r in back.collect()} == {(3, 1), (4, 3)} and RAW.read_raw_table(spark, raw).count() == 4


def test_a_batch_takes_no_storage_memory(spark, tmp_path, monkeypatch):
    from sparktrail.streaming.store import CleanStore

    def stored():
        return {i.id(): (i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    before, seen, commit = stored(), [], CleanStore.commit

    def looked(*args):
        seen.append({k: v for k, v in stored().items() if k not in before})
        return commit(*args)
    with monkeypatch.context() as m:
        m.setattr(CleanStore, "commit", looked)
        run(spark, str(tmp_path), 0, {"o1": [document(1, 10), document(2, 20, kind="leave"), document(3, 30, kind="timeout")]})
    assert len(seen) == 1 and seen[0] and sum(mem for mem, _ in seen[0].values()) == 0 < sum(disk for _, disk in seen[0].values())
    assert not [k for k in stored() if k in seen[0]]
    assert {r.ord for r in rows_of(spark, str(tmp_path)).collect()} == {1}


def test_only_documents_of_the_asked_types_are_kept(spark):
    from sparktrail.operators.flatten import flatten
    from sparktrail.streaming.ingest import _of_types
    click = '{"web_id":"w","event_type":"onpage","uuid":"u","timestamp":1,"click_info":{"s_id":"s"}}'
    texts = [document(1, 10), document(2, 20, kind="leave"), document(3, 30, kind="timeout"), click, '{"web_id":"w"}', '{"event_type":null}']
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ord long, t string").select("ord", F.parse_json("t").alias("ev"))
    for types, some in ((["load"], {0}), (["leave", "clicks"], {1, 3}), (["load", "leave", "timeout", "clicks"], {0, 1, 2, 3})):
        kept = _of_types(docs, types)
        assert {r.ord for r in kept.collect()} == some
        for t in types:
            assert flatten(kept, t).collect() == flatten(docs, t).collect() != []


def test_rows_of_the_types_arent_written_as_checkpoints(spark, tmp_path, monkeypatch):
    from sparktrail.streaming import ingest
    made, materialize = [], ingest.materialize

    def counted(df):
        made.append(df.columns)
        return materialize(df)
    with monkeypatch.context() as m:
        m.setattr(ingest, "materialize", counted)
        run(spark, str(tmp_path), 0, {"o1": [document(1, 10), document(2, 20, kind="leave"), document(3, 30, kind="timeout")]})
    assert made == [["name", "date", "slot", "batch_id"]]  # the versions only
    assert statistics(spark, str(tmp_path)) == {"2024-01-05": (1, 1, 1, 1, 0)}
