from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import catalog
from ledgerloom.llm import multi_index as M


def brute(ids, x, queries, top=20):
    out = {}
    for q in queries:
        s = x @ x[list(ids).index(q)]
        out[q] = [int(ids[i]) for i in np.lexsort((ids, -s)) if ids[i] != q][:top]
    return out


def test_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    try:
        pdf = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    except Exception:
        pytest.skip("benchmark tables not available")
    got = catalog.op8_multi_index(spark, sf).toPandas()
    x, ids = np.stack(pdf.embedding).astype(float), pdf.vec_id.to_numpy()
    want = brute(ids, x, ids[ids % 20 == 0])
    by = got.groupby("query_id").vec_id.apply(list)
    assert set(by.index) == set(want) and (got.groupby("query_id")["rank"].apply(list).map(len) == 20).all()
    assert np.mean([len(set(by[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    row = {i: k for k, i in enumerate(ids)}
    exact = np.einsum("ij,ij->i", x[[row[i] for i in got.query_id]], x[[row[i] for i in got.vec_id]])
    assert np.allclose(exact, got.score, rtol=0, atol=1e-12)


@pytest.mark.parametrize("block", [8192, 7])
def test_everything_probed_is_exact_with_ties_first_by_id(spark, block):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6)).astype(np.float32)
    x[50:120] = x[50]  # a third of all are one vector
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int")
    got = M.search(df, F.col("vec_id") % 20 == 0, probe=1.0, k=5, block=block).orderBy("query_id", "rank").collect()
    want = brute(np.arange(200), np.round(x.astype(float), 12), range(0, 200, 20))
    for q, ids in want.items():
        assert [r.vec_id for r in got if r.query_id == q] == ids
        assert [r.rank for r in got if r.query_id == q] == list(range(1, 21))


def test_copies_of_one_vector_use_up_no_probe(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] = x[0]  # a third are one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = M.search(df, F.col("vec_id") % 20 == 1).toPandas()
    assert (got.groupby("query_id").size() == 20).all()
    by = got.groupby("query_id").vec_id.apply(list)
    # queries that meet the cell of the copies early; among copies any counts
    early = [q for q in range(1, 3000, 20) if q % 3 and x[q] @ x[0] > 0]
    least = {q: np.sort(np.delete(x @ x[q], q))[-20] - 1e-9 for q in early}
    assert np.mean([np.mean(x[by[q]] @ x[q] >= least[q]) for q in early]) >= 0.9


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0]), (8, []), (None, [1.0, 1.0]), (9, [0.9, 0.1]), (9, [0.9, 0.1]), (20, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id) for r in M.search(df, F.col("vec_id") % 20 == 0, probe=1.0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 9), (0, 2, 1), (0, 3, 20), (20, 1, 1), (20, 2, 9), (20, 3, 0)]
    assert M.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert M.search(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_small_tables_give_all_that_is_asked_for(spark):
    rng = np.random.default_rng(4)
    for n in (12, 40):
        rows = [(i, rng.normal(size=8).tolist()) for i in range(n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = M.search(df, F.col("vec_id") % 20 == 0).groupBy("query_id").count().collect()
        assert {r.query_id: r["count"] for r in got} == {q: min(20, n - 1) for q in range(0, n, 20)}


def test_reach_takes_cells_by_summed_distance():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b, size = rng.random(7), rng.random(5), rng.integers(0, 4, (7, 5))
        total = a[:, None] + b[None, :]
        for want in (1, 5, int(size.sum())):
            limit = M.reach(a, b, size, want)
            assert size[total <= limit].sum() >= want > size[total < limit].sum()
    assert M.reach(np.zeros(2), np.zeros(2), np.ones((2, 2)), 9) == np.inf
