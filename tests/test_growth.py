"""Steps whose work grew faster than the input, or was done several times over."""

import re

from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_objects_are_decoded_once(spark):
    from sparktrail.sources.raw import corrupt_objects, decode_objects
    rows = [("a", '{"_ord":1}"landing"{"_ord":2}'), ("b", ""), ("c", '{"_ord":3}{"_ord":'), ("d", None), ("e", "[]")]
    objects = spark.createDataFrame(rows, "path string, text string").localCheckpoint()
    docs = decode_objects(objects)
    assert _plan(docs).count("forall(") == 1
    got = docs.select("path", "doc_pos", F.try_variant_get("ev", "$._ord", "bigint").alias("ord")).collect()
    assert {tuple(r) for r in got if r.ord} == {("a", 0, 1), ("a", 1, 2)}
    assert _plan(corrupt_objects(objects)).count("parseJson") == 1


def test_maps_of_a_row_are_made_once(spark):
    from sparktrail.operators.flatten import flatten
    docs = [(1, '{"web_id":"w","event_type":"leave","uuid":"u","timestamp":1,"fb_id":"f","ga_id":"g","coupon":"0",'
                '"record_user":"{\\"dv\\":1,\\"s_id\\":\\"s\\"}"}'),
            (2, '{"web_id":"w","event_type":"leave","uuid":null,"timestamp":1}'),
            (3, '{"web_id":"w","event_type":"leave","uuid":"u","timestamp":1,"record_user":{"dv":null}}'),
            (4, '{"web_id":"w","event_type":"leave","uuid":"u","timestamp":1,"other":null,"record_user":{"x":null}}')]
    raw = spark.createDataFrame(docs, "ord long, t string").select("ord", F.parse_json("t").alias("ev")).localCheckpoint()
    clean = flatten(raw, "leave")
    assert _plan(clean).count("record_user") == 1
    got = {r.ord: (r.device, r.session_id, r.fb_id) for r in clean.collect()}
    assert got == {1: ("1", "s", "f"), 4: ("-1", "-1", "_")}


def test_payloads_are_parsed_once_and_keys_are_taken_as_they_are(spark):
    from sparktrail.operators.flatten import flatten
    docs = [(1, """{"web_id":"w","event_type":"addCart","uuid":"u","timestamp":1,"cart":{"it's":"p1","price":3}}"""),
            (2, """{"web_id":"w","event_type":"addCart","uuid":"u","timestamp":1,"cart":{"it's":null,"price":[4]}}"""),
            (3, """{"web_id":"w","event_type":"addCart","uuid":"u","timestamp":1,"cart":"[1]"}""")]
    raw = spark.createDataFrame(docs, "ord long, t string").select("ord", F.parse_json("t").alias("ev")).localCheckpoint()
    settings = spark.createDataFrame([("w", "addCart", "it's,price", "product_id,product_price")],
                                     "web_id string, event_type string, keys string, renames string")
    clean = flatten(raw, "addCart", settings)
    assert _plan(clean).count("$.cart") == 1
    got = {(r.ord, r.product_id, r.product_price) for r in clean.collect()}
    assert got == {(1, "p1", "3"), (2, "-1", "4")}


def test_folders_are_listed_by_a_few_tasks(spark, tmp_path):
    from sparktrail.sources.raw import list_objects
    folders = 100
    for i in range(folders):
        (tmp_path / f"name=object-{i}").mkdir()
        (tmp_path / f"name=object-{i}" / "part.txt").write_text("x")
    key, tracker = "spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext.statusTracker()
    before = spark.conf.get(key)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        assert list_objects(spark, str(tmp_path)).count() == folders
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        known = [tracker.getStageInfo(s) for s in stages]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in known if s) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before


def test_objects_of_the_stream_hold_many_documents(spark):
    from smoke import SMOKE
    from sparktrail.plans import adapters as A
    from sparktrail.plans import raw_adapter as RA
    ev = A.base_events(spark, SMOKE).where("ord < 600").withColumn("ts", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    assert RA.raw_objects(ev).count() == 3
    assert RA.raw_objects(ev, ids=RA.IDS_PER_FILE).count() == 1


def test_a_listing_is_scanned_by_a_few_tasks(spark, tmp_path):
    from sparktrail.sources.raw import list_objects
    files = 40 * spark.sparkContext.defaultParallelism
    for i in range(files):
        (tmp_path / f"object-{i}.txt").write_text("x" if i else "")
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(128 << 20))  # a task for each file
    try:
        listed = list_objects(spark, str(tmp_path))
        assert listed.where("length > 0").select("path").distinct().count() == files - 1 and listed.count() == files
        scan = listed.inputFiles()
        assert len(scan) == files
        assert listed.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism + spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set(key, before)


def test_documents_of_one_file_are_written_by_many_tasks(spark):
    from pyspark.sql import types as T
    from sparktrail.plans import raw_adapter as RA
    kinds = "ord long, ts timestamp_ntz, user_id long, event_type string, value double, k int, web_id string, uuid string, session_id string, timestamp long, date_time timestamp_ntz"
    ev = (spark.range(0, 4000, 1, 1).selectExpr(
        "id AS ord", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1D AS value",
        "int(id % 7) AS k", "'w' AS web_id", "'u' AS uuid", "'s' AS session_id", "1L AS timestamp",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS date_time").to(T.StructType.fromDDL(kinds)))

    def documents(rows):
        # each task that has rows leaves its number in its documents
        return rows.select(F.col("ord").alias("event_id"), "ts", F.format_string('{"t":%d}', F.spark_partition_id()).alias("doc"))
    texts = [r.text for r in RA.raw_objects(ev, documents).collect()]
    assert len(re.findall(r"\{", "".join(texts))) == 4000
    assert len(set(re.findall(r'"t":(\d+)', "".join(texts)))) >= 2 * spark.sparkContext.defaultParallelism


def test_objects_of_the_stream_are_filled(spark):
    from sparktrail.plans import raw_adapter as RA
    # every third id of two days that take turns; some rows come twice, some have no time
    day = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id DIV 3000 % 2))"
    rows = spark.range(0, 24000, 3).selectExpr("id AS ord", f"CASE WHEN id % 1000 = 0 THEN NULL ELSE {day} END AS ts")
    rows = rows.unionAll(rows.where("ord % 500 = 0"))
    parts = RA.filled_parts(rows, "yyyy/MM/dd/'00'", 1024)

    def documents(ev):
        return ev.select(F.col("ord").alias("event_id"), "ts", F.format_string('{"_ord":%d}', "ord").alias("doc"), "part")
    objects = RA.raw_objects(parts, documents, pattern="yyyy/MM/dd/'00'", rows=rows.count()).collect()
    held = {(o.path, o.part): [int(x) for x in re.findall(r'"_ord":(\d+)', o.text)] for o in objects}
    assert len(held) == len(objects)
    assert sorted(i for ids in held.values() for i in ids) == sorted(r.ord for r in rows.collect())
    for path in {p for p, _ in held}:
        ids = [held[path, part] for part in sorted(n for p, n in held if p == path)]
        assert sum(ids, []) == sorted(sum(ids, [])) and len(ids) <= -(-sum(map(len, ids)) // 1024)
        assert all(len(x) < 1024 + 2 * RA.IDS_PER_OBJECT for x in ids)


def test_shuffles_are_sized_by_rows(spark):
    from sparktrail.plans.sizing import MOST_PARTITIONS, ROWS_PER_TASK, shuffled_for
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get(key, None)
    for rows, want in ((0, before), (least * ROWS_PER_TASK, before), (50 * ROWS_PER_TASK, "50"), (1 << 40, str(MOST_PARTITIONS))):
        try:
            with shuffled_for(spark, rows):
                assert spark.conf.get(key, None) == want
                raise KeyError
        except KeyError:
            assert spark.conf.get(key, None) == before
