"""Periodic runs against a search of all lags in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import catalog, periodic
from ledgerloom.llm.texthash import mix


def brute(w: list) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period."""
    n, best = len(w), {}
    for p in range(1, n // 3 + 1):
        i = p
        while i < n:
            if w[i] != w[i - p]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                best.setdefault((i - p, j), p)  # smaller periods came first
            i = j
    return sorted(((s, e - s, p) for (s, e), p in best.items()), key=lambda r: (r[0], r[2]))


def row(doc_id, text, damaged=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if damaged and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    drop = {i for s, m, p in runs for i in range(s + p, s + m)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
        sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)),
    )


def found(w):
    h = mix(np.array([x + 1 for x in w], np.uint64))
    s, e, p = periodic.find_runs(h, np.zeros(len(w), np.int64))
    return sorted(((a, b - a, q) for a, b, q in zip(s.tolist(), e.tolist(), p.tolist())), key=lambda r: (r[0], r[2]))


def repetitive(rng, size):
    """Nested repeats over a few letters: runs within runs, near runs, runs side by side."""
    w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 12))]
    while len(w) < size:
        k = rng.randrange(5)
        if k < 2:
            cut = w[-rng.randrange(1, len(w) + 1):]
            w += cut * rng.randrange(1, 6)
        elif k == 2:
            w += [rng.randrange(3) for _ in range(rng.randrange(4))]
        elif k == 3:
            w += w[: rng.randrange(len(w) + 1)]
        else:
            w[rng.randrange(len(w))] = rng.randrange(3)
    return w[:size]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        w = repetitive(rng, rng.randrange(1, 400))
        assert found(w) == brute(w), w


def test_known_words():
    fib = [0]
    before = [1]
    while len(fib) < 600:
        fib, before = fib + before, fib
    for w in ([0] * 23, [0] * 24, [0] * 700, [0, 1] * 300, fib, [0] * 100 + [1] + [0] * 100, [*range(8)] * 3, ([*range(9)] * 3)[:-1], ([1] * 30 + [2]) * 4):
        assert found(w) == brute(w)


def test_documents_of_a_chunk_do_not_meet():
    h = mix(np.array([1] * 20 + [1] * 20 + [2] * 30, np.uint64))
    s, e, p = periodic.find_runs(h, np.array([0] * 20 + [1] * 20 + [2] * 30))
    assert (s.tolist(), e.tolist(), p.tolist()) == ([40], [70], [1])


def test_weak_hash_is_caught():
    tokens = [b"a", b"b"] * 20
    assert periodic.runs_of(tokens, np.array([0]), np.array([40]), np.array([1])) == [(0, 40, 2)]


def test_a_very_long_text_of_one_word():
    assert found([5] * 200_000) == [(0, 200_000, 1)]


def test_tables(spark, docs_of):
    rng = random.Random(5)
    rows = [(None, "a " * 40), (1, None), (2, ""), (3, " \t\n"), (4, "a b " * 30), (4, "a b " * 30), (5, "é ü x " * 20)]
    rows += [(i, " ".join(map(str, repetitive(rng, rng.randrange(300))))) for i in range(10, 90)]
    docs = docs_of(rows)
    got = sorted((tuple(r) for r in periodic.digests(docs).collect()), key=str)
    assert got == sorted((row(*r) for r in rows), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    assert periodic.digests(docs.limit(0)).collect() == []
    whole = {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest(), len(r.runs)) for r in periodic.collapse(docs).collect()}
    assert whole == {(x[0], x[7], x[1]) for x in (row(*r, damaged=False) for r in rows)}


def test_query_on_given_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r.text or "") < 15_000]
    got = {r.doc_id: tuple(r) for r in catalog.op13_periodic_runs(spark, sf_small).collect()}
    assert len(got) == len(docs)
    assert sum(r[1] > 0 for r in got.values()) > 5
    for r in short:
        assert got[r.doc_id] == row(r.doc_id, r.text)
