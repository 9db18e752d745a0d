"""The language model's array steps against plain Python."""

from zlib import crc32

import numpy as np
import pyarrow as pa
from cases import edge_texts

from sparktrail.llm import lm_score as lm


def _plain(text):
    return [*(text or b"").lower().split(), b""]


def _texts():
    odd = ["".join(map(chr, range(1, 300))), "a\x00b A\x1cB\x1f", " \t x", "İ ǅ Å a b c", "x " * 4000]
    return [None if t is None else t.encode() for t in [*edge_texts(), *odd]]


def test_tokens_are_made_by_arrow_once_a_distinct_word():
    texts = _texts()
    want = [_plain(t) for t in texts]
    for given in (texts, pa.array([b"before", *texts, b"after"], pa.binary()).slice(1, len(texts)), []):
        words, at, sizes = lm._tokens(given)
        words = words.to_pylist()
        assert len(set(words)) == len(words)
        assert [words[i] for i in at] == [w for t in want[:len(given)] for w in t]
        assert sizes.tolist() == [len(t) for t in want[:len(given)]]


def test_tokens_are_counted_batch_by_batch(monkeypatch):
    monkeypatch.setattr(lm, "TOGETHER", 500)  # several groups a batch
    texts = _texts()
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).view(pa.string())], names=["text"])
    got = pa.Table.from_batches(list(lm._counted(iter([batch])))).to_pydict()
    flat = [w for t in texts for w in _plain(t)]
    assert dict(zip(got["token"], got["n"])) == {w: flat.count(w) for w in set(flat)}
    assert len(got["token"]) == len(set(flat))


def test_codes_of_many_words_are_those_of_each():
    classes = lm.Classes([b"the", b"of"])
    words = [b"", b"a", b"ab", b"the", b"then", b"of", "été".encode(), b"\xff"]
    codes = lm._Codes(classes).of(pa.array(words, pa.binary()))
    assert (codes & 0xFFFF).tolist() == [classes.of(w) for w in words]
    assert (codes >> 16).tolist() == [crc32(w) | 1 << 32 for w in words]


def test_a_step_sums_by_row_without_a_sort_or_a_cell_for_each_token(monkeypatch):
    rng = np.random.default_rng(3)
    n, outcomes = 500, 5
    rows = rng.integers(0, 40, (3, n)).astype(np.int32)
    y, much, bias = rng.integers(0, outcomes, n), rng.integers(1, 4, n).astype(np.float32), np.zeros(outcomes, np.float32)
    head = lm.Head(6, outcomes)
    head.weights[:] = rng.normal(size=head.weights.shape)
    want = head.weights.astype(np.float64)
    error = lm.softmax(head.weights, bias, rows).astype(np.float64)
    error[np.arange(n), y] -= 1
    for feature in rows:
        for r in set(feature.tolist()):
            mine = feature == r
            count = much[mine].sum()
            want[r] -= (error[mine] * much[mine, None]).sum(0) * lm.RATE * min(count, lm.SATURATION) / count

    def no_sort(*_, **__):
        raise AssertionError("a batch is sorted")
    monkeypatch.setattr(np, "unique", no_sort)
    head.step(bias, rows, y, much)
    assert np.allclose(head.weights, want, atol=1e-5)
    assert head.times.sum() == 3 * much.sum() and (head.times[:40] == sum(
        np.bincount(f, much, 40) for f in rows)).all()
