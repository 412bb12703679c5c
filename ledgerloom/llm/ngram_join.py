"""N-gram Jaccard self-join by prefix trees.

``similar_documents`` links documents whose sets of distinct word shingles have a
Jaccard similarity of at least ``percent`` hundredths and returns the components
of these links. The join is exact up to equal 64-bit shingle hashes.

1. Every document's set is hashed; equal sets (exact copies) form one class.
2. Of each set the ``reach`` share with the smallest hashes is its *head*. Two
   linked sets differ in at most ``n - need`` shingles of either, so their heads
   share at least ``head - (n - need)`` shingles. The heads are dealt out by
   shingle once, in packed blocks: a shingle that only one class has is useless,
   and a class with too few others is left out for good.
3. Within its head a class keeps its rarest shingles as *prefix*, as many as must
   hold one that a partner has too. Classes that meet there form a block.
4. A block's sets, ordered from the rarest shingle to the commonest, are stored in
   a prefix tree. Each set walks down the tree, sharing the overlap of a path
   among all sets below it, and leaves a subtree when the shingles that remain
   cannot reach the overlap needed, or when all of it is linked already.
   A block above ``block_rows`` sets is cut into parts, and every pair of parts is
   one group, so no task holds more than two parts.

Null and empty texts have an empty set and no links. Repeated rows and documents
that share a ``doc_id`` count as that document; rows with a null ``doc_id`` are
returned with the component of equal texts if any other id links to them, else null.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components
from ledgerloom.llm.shared import saved
from ledgerloom.llm.texthash import (
    BLANK, LOWER, U, Dealer, buckets_of, chunks, gather, grams, mix, word_hash, words,
)

SHINGLE = 5
PERCENT = 80
#: Sets in one part of a block.
BLOCK_ROWS = 4096


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of n with any set it is linked to."""
    return (n * percent + 99) // 100


def head_size(n: np.ndarray, percent: int) -> np.ndarray:
    """One and a half times the longest possible run of unshared shingles, and one more."""
    return np.minimum(n, (n - needed(n, percent)) * 3 // 2 + 1)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, set sizes of a run of rows, their hashes one set after the other, each ascending)."""
    for first, last, buf, off in chunks(column):
        buf = LOWER[buf]
        start, end, doc = words(buf, off, BLANK)
        h = word_hash(buf, start, end)
        g, at = grams(h, doc, size)
        owner = doc[at]
        count = np.bincount(doc, minlength=last - first)
        begin = np.concatenate([[0], np.cumsum(count)])
        few = np.flatnonzero((count > 0) & (count < size))
        if len(few):  # the whole sequence is one shingle
            total = np.zeros(len(few), U)
            for j in range(size - 1):
                has = count[few] > j
                total[has] = total[has] * U(0x9E3779B97F4A7C15) + h[begin[few[has]] + j]
            g = np.concatenate([g, mix(total + count[few].astype(U))])
            owner = np.concatenate([owner, few])
        order = np.lexsort((g, owner))
        g, owner = g[order], owner[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
        g, owner = g[new], owner[new]
        yield first, np.bincount(owner, minlength=last - first), g


def digests(n: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    begin = np.concatenate([[0], np.cumsum(n)])
    out = []
    for salt in (1, 2):
        total = np.concatenate([[U(0)], np.cumsum(mix(g + U(salt)), dtype=U)])
        out.append(mix(total[begin[1:]] - total[begin[:-1]] + n.astype(U)).view(np.int64))
    return out[0], out[1]


def _classes(docs: DataFrame, size: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, n, g in shingle_sets(batch.column(1), size):
                c1, c2 = digests(n, g)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(n)), pa.array(n.astype(np.int64)), pa.array(c1), pa.array(c2)], schema=schema
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, c1 long, c2 long")


def _heads(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """Head shingles of every set, packed by shingle: (bucket, shingles, classes, set sizes)."""
    schema = pa.schema([("bucket", pa.int32()), ("g", pa.binary()), ("c", pa.binary()), ("n", pa.binary())])

    def run(batches):
        out = Dealer(buckets)
        for batch in batches:
            for _, n, g in shingle_sets(batch.column(1), size):
                c1, _ = digests(n, g)
                begin = np.cumsum(n) - n
                rank = np.arange(len(g)) - np.repeat(begin, n)
                # a set whose copy lies in the same run is dealt out once
                lead = np.zeros(len(n), bool)
                lead[np.unique(c1, return_index=True)[1]] = True
                keep = (rank < np.repeat(head_size(n, percent), n)) & np.repeat(lead, n)
                out.add(g[keep], g[keep], np.repeat(c1, n)[keep], np.repeat(n, n)[keep].astype(np.int32))
                if out.full:
                    yield from out.flush(schema)
        yield from out.flush(schema)

    return docs.mapInArrow(run, "bucket int, g binary, c binary, n binary")


def _shared(heads: DataFrame, buckets: int) -> DataFrame:
    """Head shingles that two classes or more have, packed by class, with how many classes have each and the least of them."""
    schema = pa.schema(
        [("bucket", pa.int32()), ("c", pa.binary()), ("n", pa.binary()), ("df", pa.binary()), ("lead", pa.binary())]
    )

    def run(batches):
        out = Dealer(buckets)
        for g, c, n in gather(batches, [U, np.int64, np.int32]):
            order = np.lexsort((c, g))
            g, c, n = g[order], c[order], n[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
            g, c, n = g[new], c[new], n[new]
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            df = np.diff(np.concatenate([first, [len(g)]]))
            many = np.repeat(df > 1, df)
            out.add(
                mix(c[many].view(U)), c[many], n[many],
                np.repeat(df, df)[many].astype(np.int32), np.repeat(c[first], df)[many],
            )
            if out.full:
                yield from out.flush(schema)
        yield from out.flush(schema)

    return heads.mapInArrow(run, "bucket int, c binary, n binary, df binary, lead binary")


def _meetings(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes that can have a partner, each with the leads of its rarest shared shingles."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for c, n, df, lead in gather(batches, [np.int64, np.int32, np.int32, np.int64]):
            order = np.lexsort((lead, df, c))
            c, n, lead = c[order], n[order].astype(np.int64), lead[order]
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            count = np.diff(np.concatenate([first, [len(c)]]))
            size = n[first]
            head = head_size(size, percent)
            least = head - (size - needed(size, percent))  # shared with one partner at least
            rank = np.arange(len(c)) - np.repeat(first, count)
            # unshared ones come first in the order by rarity, so the prefix ends so much earlier here
            prefix = count - least + 1
            keep = rank < np.repeat(np.where(count >= least, prefix, 0), count)
            pairs = np.unique(np.stack([c[keep], lead[keep]], axis=1), axis=0) if keep.any() else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], schema=schema)

    return shared.mapInArrow(run, "a long, b long")


class _Node:
    __slots__ = ("label", "kids", "rows", "least", "deep", "group")

    def __init__(self, label):
        self.label, self.kids, self.rows, self.least, self.deep, self.group = label, {}, [], 1 << 60, 0, -1


class PrefixTree:
    """Sets as paths of ranked shingles. Each node knows the smallest set and the
    longest path below it, and the group of linked sets if all below are of one."""

    def __init__(self, find):
        self.root, self.find = _Node([]), find

    def insert(self, path: list[int], size: int, row: int) -> None:
        node, at, length = self.root, 0, len(path)
        self._widen(node, size, length, row)
        while at < length:
            kid = node.kids.get(path[at])
            if kid is None:
                kid = _Node(path[at:])
                node.kids[path[at]] = kid
                node, at = kid, length
            else:
                label, k = kid.label, 1
                while k < len(label) and at + k < length and label[k] == path[at + k]:
                    k += 1
                if k < len(label):  # split the edge
                    mid = _Node(label[:k])
                    mid.least, mid.deep, mid.group = kid.least, kid.deep, kid.group
                    kid.label = label[k:]
                    mid.kids[label[k]] = kid
                    node.kids[path[at]] = mid
                    kid = mid
                node, at = kid, at + k
            self._widen(node, size, length, row)
        node.rows.append((row, size))

    def _widen(self, node: _Node, size: int, length: int, row: int) -> None:
        node.least, node.deep = min(node.least, size), max(node.deep, length)
        if node.group != -2:
            node.group = row if node.group == -1 or self.find(node.group) == self.find(row) else -2

    def partners(self, path: list[int], size: int, row: int, percent: int, link) -> None:
        """Calls ``link`` for one set at least of every group of linked sets that has
        a partner of ``path``; stops when ``link`` says that all sets are one group."""
        find, has, length = self.find, set(path), len(path)
        stack = [(self.root, 0, 0)]
        while stack:
            node, depth, overlap = stack.pop()
            if node.group >= 0 and find(node.group) == find(row):
                continue  # all sets below are linked with this one already
            need = -(-percent * (size + node.least) // (100 + percent))
            remain = length
            if node.label:
                remain -= bisect_right(path, node.label[-1])
                overlap += len(has.intersection(node.label))
                depth += len(node.label)
            for other, n in node.rows:
                if 100 * overlap >= percent * (size + n - overlap) and link(row, other):
                    return
            if overlap + min(remain, node.deep - depth) >= need:
                stack.extend((kid, depth, overlap) for kid in node.kids.values())


def link_block(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the same sets as all links of the block do (a forest)."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found, groups = [], 0

    def link(i, j):
        nonlocal groups
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            found.append((i, j))
            groups -= 1
        return groups == 1

    tokens, where, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, df))] = np.arange(len(tokens))
    ranked, shared = rank[where], df[where] > 1
    ends = np.cumsum([len(s) for s in sets])
    tree = PrefixTree(find)
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        size = len(sets[i])
        own = slice(ends[i] - size, ends[i])
        path = np.sort(ranked[own][shared[own]]).tolist()  # what no other set has only counts in the size
        if 100 * len(path) < percent * size:
            continue
        groups += 1
        tree.partners(path, size, i, percent, link)
        tree.insert(path, size, i)
    return found


def similar_documents(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    buckets = buckets_of(spark)
    classes = saved(_classes(docs, size))
    leads = classes.filter("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")
    )

    heads = _heads(docs, size, percent, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    shared = _shared(heads, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    meetings = saved(_meetings(shared, percent))
    # a lead that cannot have a partner itself still joins those that meet at it
    blocks = components(meetings)

    wanted = saved(
        leads.join(meetings.select(F.col("a").alias("c1")).distinct(), "c1")
        .join(blocks.select(F.col("node").alias("c1"), "component"), "c1")
        .select("rep", "c1", "c2", F.col("component").alias("block"))
    )
    wide = wanted.groupBy("block").agg(F.count("*").alias("n"))
    wide = wide.filter("n > 1").select("block", F.ceil(F.col("n") / block_rows).cast("int").alias("parts"))
    wanted = wanted.join(wide, "block").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    # every pair of parts of a wide block is a group; a block of one part is one
    wanted = wanted.select("rep", "c1", "c2", "block", "part", "parts")
    texts = docs.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id")
    links = _linked(_sets(texts, size), percent)
    # documents that share an id are one document: their classes are linked through it
    known = classes.filter("n_shingles > 0 and doc_id is not null")
    shared_ids = known.groupBy("doc_id").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("c1", "c2")))
    shared_ids = shared_ids.filter("min_c1 <> max_c1 or min_c2 <> max_c2").select("doc_id")
    own = known.join(shared_ids, "doc_id").join(leads, ["c1", "c2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(own))

    grouped = leads.join(found.select(F.col("node").alias("rep"), F.col("component").alias("linked")), "rep", "left")
    grouped = grouped.select("c1", "c2", F.coalesce("linked", "rep").alias("component"))
    out = classes.join(grouped, ["c1", "c2"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _sets(texts: DataFrame, size: int) -> DataFrame:
    schema = pa.schema(
        [(x, pa.int64()) for x in ("doc_id", "c1", "c2", "block")] + [("part", pa.int32()), ("parts", pa.int32()), ("s", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            c1, c2 = col["c1"].to_numpy(), col["c2"].to_numpy()
            for first, n, g in shingle_sets(col["text"], size):
                rows = slice(first, first + len(n))
                d1, d2 = digests(n, g)
                same = (d1 == c1[rows]) & (d2 == c2[rows])
                end = np.cumsum(n)
                sets = [g[e - k : e].tobytes() if ok else None for e, k, ok in zip(end, n, same, strict=True)]
                out = [col[x].slice(first, len(n)) for x in ("doc_id", "c1", "c2", "block", "part", "parts")]
                whole = pa.RecordBatch.from_arrays([*out, pa.array(sets, pa.binary())], schema=schema)
                yield whole.filter(pa.array(same))

    return texts.select("doc_id", "text", "c1", "c2", "block", "part", "parts").mapInArrow(
        run, "doc_id long, c1 long, c2 long, block long, part int, parts int, s binary"
    )


def _linked(sets: DataFrame, percent: int) -> DataFrame:
    """Links within each group of at most two parts."""
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    pairs = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(
            F.filter(every, lambda x: x != F.col("part")),
            lambda x: F.struct(F.least(x, "part").alias("i"), F.greatest(x, "part").alias("j")),
        )
    )
    groups = sets.withColumn("ij", F.explode(pairs)).select("doc_id", "c1", "c2", "block", "ij.i", "ij.j", "s")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # several texts can share the id that stands for them
        key = ["doc_id", "c1", "c2"]
        pdf = pdf.sort_values(key).drop_duplicates(key)
        ids = pdf["doc_id"].to_numpy()
        found = link_block([np.frombuffer(x, dtype=U) for x in pdf["s"]], percent)
        return pd.DataFrame(
            {"a": ids[[i for i, _ in found]], "b": ids[[j for _, j in found]]}, columns=["a", "b"], dtype="int64"
        )

    return groups.groupBy("block", "i", "j").applyInPandas(run, "a long, b long")
