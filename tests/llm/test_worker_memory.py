"""Encoders take a batch in steps, so that a worker's memory doesn't grow with the batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from paddock.llm import bpe, token_files
from paddock.llm.common import text_slices


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def new_words(n_texts, n_words):
    r = random.Random(5)
    return [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(n_words)) for _ in range(n_texts)]


def test_slices_hold_every_row_once():
    texts = ["a" * n for n in (5, 0, 3, 40, 2, 2)] + [None, "é" * 6]
    batch = pa.RecordBatch.from_pydict({"id": [*range(8)], "t": pa.array(texts, pa.string())})
    parts = [x.column(1).to_pylist() for x in text_slices(batch, 1, 10)]
    assert sum(parts, []) == texts and parts == [texts[:3], texts[3:4], texts[4:7], texts[7:]]
    assert [x.column(0).to_pylist() for x in text_slices(batch.slice(4), 1, 10)] == [[4, 5, 6], [7]]
    assert [*text_slices(batch.slice(0, 0), 1, 10)] == []


def test_new_pre_tokens_meet_in_bounded_queues():
    c = bpe.Codec(*bpe.default_vocabulary())
    texts = new_words(250, 1000)
    ids, peak = peak_mb(lambda: c.encode(texts))
    assert peak < 150
    c.forget()
    assert ids[249].tolist() == c.encode(texts[249:])[0].tolist() and c.decode(ids[249]) == texts[249].encode()


@pytest.mark.parametrize("sign", ["", " Ж"])
def test_long_texts_are_encoded_in_pieces(monkeypatch, sign):
    at = bpe.default_vocabulary()
    texts = [" it's  the" + sign, "", "x" * 200 + sign, *(x + sign for x in new_words(3, 40)), "  \n\n a 12345 " * 9 + sign]
    want = [x.tolist() for x in bpe.Codec(*at).encode(texts)]
    for name, value in (("STEP_BYTES", 50), ("STEP_TOKENS", 7), ("CACHE_ENTRIES", 10)):
        monkeypatch.setattr(bpe, name, value)
    c, most = bpe.Codec(*at), []
    merge = c.shared.merge
    monkeypatch.setattr(c.shared, "merge", lambda pieces: most.append(len(pieces)) or merge(pieces))
    assert [x.tolist() for x in c.encode(texts)] == want
    assert max(most) <= 14


def test_a_shard_is_packed_and_read_in_little_memory():
    r = np.random.default_rng(7)
    ids = [(r.zipf(1.2, n) % 40_000).astype(np.uint32) for n in r.integers(1, 4000, 500)]
    total = sum(map(len, ids))
    data, peak = peak_mb(lambda: token_files.pack_shard([*range(500)], ids, 40_000))
    assert peak * 1e6 < 60 * total
    shard = token_files.Shard(data)
    read, peak = peak_mb(shard.all)
    assert np.array_equal(read, np.concatenate(ids)) and peak * 1e6 < 25 * total
