"""What a Python worker holds once its task is done."""

import pyarrow as pa


def test_arrow_gives_back_what_it_freed_between_batches(monkeypatch):
    from sparktrail.llm import common

    class Pool:
        times = 0

        def release_unused(self):
            self.times += 1

    pool = Pool()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    seen = []
    for batch in common.released(iter(batches)):
        seen.append((batch, pool.times))
    assert [t for _, t in seen] == [0, 1, 2] and pool.times == 3
    assert [b.column(0)[0].as_py() for b, _ in seen] == [0, 1, 2]


def test_encoding_gives_memory_back(monkeypatch):
    from sparktrail.llm import common, sentencepiece_codec

    calls = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda _: calls.append(1)})())
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two", None])], names=["id", "text"])
    rows = pa.Table.from_batches(list(sentencepiece_codec._encoded(sentencepiece_codec.MODEL, iter([batch])))).to_pylist()
    assert len(calls) == 1 and [r["round_trip"] for r in rows] == [True, True]
