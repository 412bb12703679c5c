from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import texthash as H


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\tçé", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_are_those_of_split(texts, limit):
    seen = []
    for first, last, buf, off in H.chunks(pa.array(texts, pa.string()), limit):
        start, end, doc = H.words(buf, off, H.BLANK)
        seen += [(first + d, buf[s:e].tobytes()) for s, e, d in zip(start, end, doc, strict=True)]
        assert last > first
    assert seen == [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().split()]


def test_equal_words_and_spans_hash_alike_anywhere():
    buf = np.frombuffer(b"one two one two one", np.uint8)
    start, end, _ = H.words(buf, np.array([0, len(buf)]), H.BLANK)
    h = H.word_hash(buf, start, end)
    assert h[0] == h[2] == h[4] and h[1] == h[3] != h[0]
    g, at = H.grams(h, np.zeros(5, int), 2)
    assert g[0] == g[2] and g[1] == g[3] and g[0] != g[1] and at.tolist() == [0, 1, 2, 3]


def test_grams_do_not_cross_documents():
    g, at = H.grams(np.arange(5, dtype=np.uint64), np.array([0, 0, 0, 1, 1]), 2)
    assert at.tolist() == [0, 1, 3]


def test_latin_capitals_fold():
    assert H.lower_latin(np.frombuffer("ÉÀÖxÇ×".encode(), np.uint8)).tobytes().decode() == "éàöxç×"


def test_dealt_blocks_come_back_whole():
    out = H.Dealer(4)
    key = np.arange(100, dtype=np.uint64)
    out.add(key, key, key.astype(np.int32))
    schema = pa.schema([("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
    batches = list(out.flush(schema))
    got = [np.stack([a.astype(np.int64), b]) for a, b in H.gather(iter(batches), [np.uint64, np.int32])]
    assert sorted(np.concatenate(got, axis=1)[0].tolist()) == list(range(100))
    assert all((x[0] % 4 == x[0][0] % 4).all() and (x[0] == x[1]).all() for x in got)
