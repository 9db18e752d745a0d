"""The corpus pipeline, stage by stage against brute force."""

import os
from collections import Counter

import brute
import corpus_pipeline
import sentencepiece

from sparktrail.llm.common import table
from sparktrail.llm.secret_scan import redacted, scan
from sparktrail.llm.sentencepiece_codec import MARK, MODEL

SF = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")


def test_pipeline(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "lang", "source").collect()]
    good = [r for r, q in zip(rows, brute.quality([r[1:] for r in rows])) if q["kept"]]
    classes = brute.components([(i, brute.fingerprint(t)) for i, t, *_ in good])
    left = {i for *_, i in classes}
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    leaked = {d for d, _ in brute.leaks([r[:2] for r in good if r[0] in left], items)}
    texts = {i: redacted(t, scan(t)["places"]) for i, t, *_ in good if i in left - leaked}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in got) == Counter((i, tuple(sp.encode(t))) for i, t in texts.items())
    assert all(r.round_trip for r in got if MARK not in texts[r.doc_id])
    assert 0 < len(got) < len(rows)


def test_stages_keep_the_columns(spark, edge):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge, SF).columns == edge.columns
