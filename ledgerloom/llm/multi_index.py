"""Nearest neighbours by inner product with an inverted multi-index (Babenko, Lempitsky).

The two halves of a vector are quantised on their own with ``k`` centroids each,
which cuts space into ``k * k`` cells. A query sorts the centroids of either half by
their distance to its own half (here: how much smaller the inner product is than
with the best centroid) and takes pairs of centroids by the sum of both distances
from a heap, until the cells taken hold the share ``probe`` of all different vectors. The
sum reached is the query's limit: every vector in a cell within it is compared exactly,
in double precision, dimension by dimension.

Equal vectors are one class, indexed, counted and compared once, so that copies use up
no probe. A class carries its ``top + 1`` smallest ids (equal scores rank by id, and one
may be the query's own); the others cannot be among the first ``top``.

``k`` and ``probe`` are fixed, so recall holds as the table grows. They are set for
vectors with little structure (recall of the 20 nearest is measured in the README);
clustered vectors need a far smaller share. The codebooks are fitted on at most
``max_sample`` vectors, the first by the hash of their id; every vector is indexed.

Index and queries meet by shelf: ``SHELF`` neighbouring centroids of the first half. A
query goes to the shelves that have a cell within its limit. A shelf with more than
``block`` classes or queries (a third of which may be one vector) is cut into parts, and
a task holds one part of each at a time.

Vectors that are null, zero, hold null or non-finite components, or have another
length than most (ties: the shorter) take no part, nor do rows without id. Of
several vectors with one id the smallest counts. A query's own id is no candidate.
"""

from __future__ import annotations

from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import saved

TOP = 20
CENTROIDS = 128
PROBE = 0.4
MAX_SAMPLE = 20_000
BLOCK = 8192
SHELF = 8


def centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows of ``x`` ordered by their first principal direction."""
    x = np.unique(x, axis=0)
    k = max(1, min(k, len(x)))
    main = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)[2][0]
    out = x[np.argsort(x @ main, kind="stable")[np.linspace(0, len(x) - 1, k).astype(int)]].copy()
    for _ in range(rounds):
        own = nearest(x, out)
        n = np.bincount(own, minlength=k)
        total = np.stack([np.bincount(own, weights=x[:, d], minlength=k) for d in range(x.shape[1])], axis=1)
        out[n > 0] = total[n > 0] / n[n > 0, None]
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(axis=1)[None, :] - 2 * x @ c.T, axis=1)


def reach(a: np.ndarray, b: np.ndarray, size: np.ndarray, probe: int) -> float:
    """The sum of distances up to which cells hold ``probe`` vectors: pairs of centroids
    are taken by ``a[i] + b[j]`` from a heap with one open pair for each i."""
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    x, y, held = a[by_a].tolist(), b[by_b].tolist(), 0
    rows = size[np.ix_(by_a, by_b)].tolist()
    heap, opened = [(x[0] + y[0], 0, 0)], 1
    while heap:
        total, i, j = heap[0]
        held += rows[i][j]
        if held >= probe:
            return total
        if j + 1 < len(y):
            heapreplace(heap, (x[i] + y[j + 1], i, j + 1))
        else:
            heappop(heap)
        if j == 0 and opened < len(x):  # the next row can only now come
            heappush(heap, (x[opened] + y[0], opened, 0))
            opened += 1
    return np.inf


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row inner products in double precision, summed dimension by dimension (alike wherever a row stands)."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * x[:, d]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding): one vector for each id that takes part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    good = rows.filter(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    good = good.filter(F.size("embedding") == (sizes[0].n if sizes else 0))
    return good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def classes(good: DataFrame, members: int) -> DataFrame:
    """(embedding, vec_ids): the different vectors, each with its ``members`` smallest ids in order."""

    def fold(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), np.ascontiguousarray(_matrix(batch.column(1)))
            own = np.unique(x.view(f"V{x.shape[1] * x.itemsize}").ravel(), return_inverse=True)[1]
            order = np.lexsort((ids, own))
            first = np.flatnonzero(np.diff(own[order], prepend=-1))
            order = order[np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order))) < members]
            first = np.flatnonzero(np.diff(own[order], prepend=-1))
            held = pa.ListArray.from_arrays(pa.array([*first, len(order)], pa.int32()), pa.array(ids[order], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(order[first])), held], names=["embedding", "vec_ids"])

    # cut in each batch first: no list of all ids of a common vector is ever made
    some = good.select("vec_id", "embedding").mapInArrow(fold, "embedding array<double>, vec_ids array<long>")
    every = F.array_sort(F.flatten(F.collect_list("vec_ids")))
    return some.groupBy("embedding").agg(F.slice(every, 1, members).alias("vec_ids"))


def search(
    vectors: DataFrame, is_query: Column, top: int = TOP, probe: float = PROBE, k: int = CENTROIDS,
    max_sample: int = MAX_SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> query_id, rank, vec_id, score of the ``top`` nearest found."""
    spark = vectors.sparkSession
    good = saved(valid_vectors(vectors))
    different = saved(classes(good, top + 1).select(F.col("vec_ids")[0].alias("vec_id"), "embedding", "vec_ids"))

    def train(batches):
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        ids = np.concatenate([b.column(0).to_numpy() for b in rows])
        x = np.concatenate([_matrix(b.column(1)) for b in rows])[np.argsort(ids, kind="stable")]
        half = (x.shape[1] + 1) // 2
        books = [centroids(p, k) if p.shape[1] else np.zeros((1, 0)) for p in (x[:, :half], x[:, half:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([half]), *(pa.array([b.tobytes()], pa.binary()) for b in books), *(pa.array([len(b)]) for b in books)],
            names=["half", "a", "b", "n", "m"],
        )

    sample = different.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(max_sample).repartition(1)  # the bound of the sample
    fitted = sample.mapInArrow(train, "half long, a binary, b binary, n long, m long").collect()
    if not fitted:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    half = fitted[0].half
    a, b = (np.frombuffer(x).reshape(n, -1) for x, n in ((fitted[0].a, fitted[0].n), (fitted[0].b, fitted[0].m)))

    def place(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            cell = nearest(x[:, :half], a) * len(b) + nearest(x[:, half:], b) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=["vec_id", "embedding", "vec_ids", "cell"])

    index = saved(different.mapInArrow(place, "vec_id long, embedding array<double>, vec_ids array<long>, cell int"))
    index = index.withColumn("shelf", F.floor(F.col("cell") / (len(b) * SHELF)).cast("int"))
    size = np.zeros(len(a) * len(b), np.int64)
    for r in index.groupBy("cell").count().collect():  # k * k rows at most
        size[r.cell] = r["count"]
    want = max(int(np.ceil(probe * size.sum())), top + 1)  # one may be the query's own

    def far(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of each query to the centroids of either half."""
        near = (q[:, :half] @ a.T, q[:, half:] @ b.T)
        return tuple(n.max(axis=1, keepdims=True) - n for n in near)

    def walk(batches):
        grid = size.reshape(len(a), len(b))
        for batch in batches:
            ids, x = batch.column(0), _matrix(batch.column(1))
            to_a, to_b = far(x) if len(x) else (np.zeros((0, 1)),) * 2
            row, shelf, limits = [], [], []
            for i in range(len(x)):
                limit = reach(to_a[i], to_b[i], grid, want) + 1e-9  # the cells of equal sums come too
                for s in np.unique(np.flatnonzero(to_a[i] <= limit) // SHELF):
                    row.append(i)
                    shelf.append(int(s))
                    limits.append(limit)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), batch.column(1).take(take), pa.array(limits, pa.float64()), pa.array(shelf, pa.int32())],
                names=["query_id", "query", "limit", "shelf"],
            )

    queries = good.filter(is_query).select("vec_id", "embedding").repartition(spark.sparkContext.defaultParallelism)
    visits = saved(queries.mapInArrow(walk, "query_id long, query array<double>, limit double, shelf int"))
    parts = index.groupBy("shelf").agg(F.ceil(F.count("*") / block).cast("int").alias("vparts"))
    parts = parts.join(visits.groupBy("shelf").agg(F.ceil(F.count("*") / block).cast("int").alias("qparts")), "shelf")
    v = index.join(parts, "shelf").withColumn("v", F.pmod(F.xxhash64("vec_id"), "vparts").cast("int"))
    v = v.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("qparts") - 1))).select("shelf", "v", "q", "vec_id", "embedding", "vec_ids", "cell")
    q = visits.join(parts, "shelf").withColumn("q", F.pmod(F.xxhash64("query_id"), "qparts").cast("int"))
    q = q.withColumn("v", F.explode(F.sequence(F.lit(0), F.col("vparts") - 1))).select("shelf", "v", "q", "query_id", "query", "limit")

    def compare(some: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        found = found.sort_values("vec_id")
        cell, members = found["cell"].to_numpy(), found["vec_ids"].map(len).to_numpy(np.int64)
        ids, start = (np.concatenate(found["vec_ids"].to_numpy()), np.cumsum(members) - members) if len(found) else (None, None)
        x = np.stack(found["embedding"].to_numpy()) if len(found) else np.zeros((0, 1))
        for at in range(0, len(some) if len(found) else 0, 256):
            own = some["query_id"].to_numpy()[at : at + 256]
            y = np.stack(some["query"].to_numpy()[at : at + 256])
            to_a, to_b = far(y)
            s = y @ x.T
            s[to_a[:, cell // len(b)] + to_b[:, cell % len(b)] > some["limit"].to_numpy()[at : at + 256, None]] = -np.inf
            # classes that may be among the first by the exact measure, which this one follows
            # closely; one more than ``top``, as the query's own may have no other id
            least = np.partition(s, -top - 1, axis=1)[:, -top - 1] if s.shape[1] > top + 1 else np.full(len(s), -np.inf)
            row, col = np.nonzero((s >= (least - 1e-6 * (1 + np.abs(least)))[:, None]) & (s > -np.inf))
            exact = inner(y[row], x[col])
            n = members[col]
            at_id = np.repeat(start[col], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, exact, found_id = np.repeat(row, n), np.repeat(exact, n), ids[at_id]
            other = found_id != own[row]
            row, exact, found_id = row[other], exact[other], found_id[other]
            order = np.lexsort((found_id, -exact, row))
            row, exact, found_id = row[order], exact[order], found_id[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < top
            out.append(pd.DataFrame({"query_id": own[row[keep]], "vec_id": found_id[keep], "score": exact[keep]}))
        return pd.concat(out)

    keys = ["shelf", "v", "q"]
    near = q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(compare, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
