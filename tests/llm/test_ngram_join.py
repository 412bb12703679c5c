from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm import ngram_join as J
from ledgerloom.llm.graph import components


def brute(rows, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[i] = s
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            a, b = sets[x], sets[y]
            if x < y and a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(find(x), find(y))] = min(find(x), find(y))
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, families=12, size=9):
    rnd = random.Random(seed)
    rows, passage = [], " ".join(f"p{k}" for k in range(30))
    for f in range(families):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([4, 6, 12, 40, 90]))]
        for _ in range(size):
            own = list(base)
            for _ in range(rnd.randrange(3)):
                own[rnd.randrange(len(own))] = f"e{rnd.randrange(10**6)}"
            text = " ".join(own) + (" " + passage if rnd.random() < 0.3 else "")
            rows.append((len(rows), text.upper() if rnd.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 4096), (3, 3)])
def test_equals_all_pairs(spark, docs_of, seed, block):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_documents(docs_of(rows), block_rows=block).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) < len(rows)


def test_edge_cases(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(5, None), (6, ""), (7, " \n"), (1, "a b"), (2, "A  b"), (3, "a b c"), (9, long), (8, long + " x"), (8, long + " x"), (None, "a b"), (None, None)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in J.similar_documents(docs_of(rows)).collect()}
    assert got == {(5, 0, 5), (6, 0, 6), (7, 0, 7), (1, 1, 1), (2, 1, 1), (3, 1, 3), (9, 59_996, 8), (8, 59_997, 8), (None, 1, 1), (None, 0, None)}
    assert J.similar_documents(docs_of([])).count() == 0


def test_heads_of_linked_sets_always_meet():
    """What steps 2 and 3 rely on, for all sizes up to 600."""
    for percent in (50, 80, 95):
        n = np.arange(1, 601)
        head, miss = J.head_size(n, percent), n - J.needed(n, percent)
        x, y = np.meshgrid(n, n, indexing="ij")
        overlap = -(-percent * (x + y) // (100 + percent))
        shared = np.minimum(head[x - 1] - (x - overlap), head[y - 1] - (y - overlap))
        least = head - miss
        assert (least >= 1).all()
        assert (shared >= np.maximum(least[x - 1], least[y - 1]))[overlap <= np.minimum(x, y)].all()


@pytest.mark.parametrize("seed", range(8))
def test_prefix_tree_connects_what_all_pairs_do(seed):
    rng = np.random.default_rng(seed)
    base = [np.sort(rng.choice(400, rng.integers(1, 60), replace=False)) for _ in range(6)]
    sets = []
    for _ in range(60):
        s = base[rng.integers(6)]
        sets.append(np.unique(np.where(rng.random(len(s)) < 0.08, rng.integers(0, 400, len(s)), s)).astype(np.uint64))
    joined = {(i, j) for i in range(60) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}

    def groups(links):
        p = list(range(60))

        def find(i):
            return i if p[i] == i else find(p[i])

        for i, j in links:
            p[find(i)] = find(j)
        return {frozenset(i for i in range(60) if find(i) == r) for r in {find(i) for i in range(60)}}

    found = J.link_block(sets, 80)
    assert groups(found) == groups(joined)
    assert all((max(x), min(x)) in joined for x in found)


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 9)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 600 + i) for i in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, **{100 + i: 100 for i in range(41)}, 500: 500, **{600 + i: 500 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shared_id_brute(rows):
    """Components over rows, then over rows of one id."""
    found = brute([(k, t) for k, (_, t) in enumerate(rows)])
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, (i, _) in enumerate(rows):
        if found[k][0]:
            parent[find(("row", found[k][1]))] = find(("id", i))
    least = {}
    for k, (i, _) in enumerate(rows):
        if found[k][0]:
            root = find(("id", i))
            least[root] = min(i, least.get(root, i))
    return sorted((i, found[k][0], least[find(("id", i))] if found[k][0] else i) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("seed", range(3))
def test_rows_that_share_an_id(spark, docs_of, seed):
    rnd = random.Random(seed)
    a, b = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " x"), (9, "c d e f g h")]
    if seed:
        rows = [(rnd.randrange(40), t) for _, t in corpus(seed, 8, 7)] + [(50, None), (50, ""), (50, "x y")]
    got = sorted(tuple(r) for r in J.similar_documents(docs_of(rows)).collect())
    assert got == shared_id_brute(rows)
