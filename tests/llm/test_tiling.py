from __future__ import annotations

import random
import re

import numpy as np
import pytest

from ledgerloom.llm import tiling as T


def greedy(doc, item, size):
    """Greedy string tiling by its definition."""
    used_d, used_i, out = set(), set(), []
    while True:
        best = None
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in used_d and j + k not in used_i:
                    k += 1
                if k >= size and (best is None or (-k, i, j) < best):
                    best = (-k, i, j)
        if best is None:
            return sorted(out)
        k, i, j = -best[0], best[1], best[2]
        out.append((i, j, k))
        used_d.update(range(i, i + k))
        used_i.update(range(j, j + k))


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.mark.parametrize("seed", range(12))
def test_tiles_are_those_of_the_definition(seed):
    rnd = random.Random(seed)
    item = [rnd.choice("abcdef") for _ in range(30)]
    doc = [rnd.choice("abcdef") for _ in range(20)] + item[15:] + [rnd.choice("abc") for _ in range(5)] + item[:15]
    pairs = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i : i + 3] == item[j : j + 3]]
    assert sorted(T.tiles(np.array(pairs), 3, 3)) == greedy(doc, item, 3)


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_runs_of_places_and_seeds_are_those_of_the_pairs(most):
    rnd = random.Random(most)
    for n in (0, 1, 40):
        place = np.array(sorted(rnd.sample(range(60), n)), np.int64)
        seed, item = np.array([rnd.randrange(3) for _ in range(n)], np.int64), np.array([rnd.randrange(4) for _ in range(n)], np.int64)
        pairs = np.array([(i, j) for i, s in zip(place, seed) for j, x in enumerate(item) if s == x], np.int64).reshape(-1, 2)
        mixed = np.array(rnd.sample(range(n), n), np.int64)
        runs = T.seed_runs(place[mixed], seed[mixed], np.arange(n), item, most)
        assert sorted(T.tile_runs(*runs, 2, 2)) == sorted(T.tiles(pairs, 2, 2))
        assert sum((last - first + 1) for _, first, last in zip(*runs)) == len(pairs)


def test_phrases_repeated_in_both(spark, docs_of):
    phrase = "all work and no play makes jack a dull boy "
    rows = [(1, phrase * 3_000), (2, "a " * 50_000), (3, phrase), (4, "work and no play " + "x " * 30)]
    items = spark.createDataFrame([(1, phrase * 20), (2, "a " * 100), (None, phrase * 2)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_words, r.n_covered, r.n_tiles) for r in T.contaminated(docs_of(rows), items).collect()}
    assert got == {(1, 1): (200, 200, 1), (1, None): (20, 20, 1), (2, 2): (100, 100, 1), (3, None): (20, 10, 1)}


def test_reordered_short_and_clean(spark, docs_of):
    rnd = random.Random(3)
    text = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    item = text(40).split()
    rows = [
        (1, "Intro " + " ".join(item).upper() + "!"),
        (2, " ".join(item[20:]) + " and " + text(9) + ", " + " ".join(item[:20])),
        (3, " ".join(item[:12]) + " " + text(50)),
        (4, text(300)),
        (5, "so: Tiny, item? yes"),
        (6, None), (7, ""), (1, "Intro " + " ".join(item).upper() + "!"), (None, " ".join(item)), (8, text(30_000) + " " + " ".join(item)),
    ]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "tiny item"), (3, None), (4, ""), (1, " ".join(item))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_words, r.n_covered, r.n_tiles) for r in T.contaminated(docs_of(rows), items).collect()}
    assert got == {(1, 1): (40, 40, 1), (2, 1): (40, 40, 2), (5, 2): (2, 2, 1), (None, 1): (40, 40, 1), (8, 1): (40, 40, 1)}
    assert T.contaminated(docs_of([]), items).count() == 0
    assert T.contaminated(docs_of(rows), items.limit(0)).count() == 0


def test_equals_brute_force_on_the_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    seeds = {}
    for r in items.collect():
        w = words(r.text)
        for j in range(len(w) - 4):
            seeds.setdefault(tuple(w[j : j + 5]), set()).add(r.item_id)
    by = {r.item_id: words(r.text) for r in items.collect()}
    want = set()
    for r in docs.collect():
        d = words(r.text)
        for i in {x for k in range(len(d) - 4) for x in seeds.get(tuple(d[k : k + 5]), ())}:
            n = sum(t[2] for t in greedy(d, by[i], 5))
            if 100 * n >= T.PERCENT * len(by[i]):
                want.add((r.doc_id, i, n))
    assert {(r.doc_id, r.item_id, r.n_covered) for r in T.contaminated(docs, items).collect()} == want
