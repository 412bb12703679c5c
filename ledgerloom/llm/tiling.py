"""Benchmark decontamination by greedy string tiling (Wise, 1996).

Words are maximal runs of letters and digits, capitals folded. Every benchmark
item is cut into seeds of ``size`` consecutive words. Documents are hashed by a
running Karp-Rabin hash over their words and joined with the seeds; a fixed-size
bit table of the seeds, the only thing that is broadcast, keeps other positions
out of the shuffle. For each document and item that share a seed, the longest
common run of unmarked words is marked again and again (longest first, ties to
the smallest position in the document, then in the item) until none of ``size``
words is left. A document is contaminated by an item when the marked words cover
at least ``percent`` hundredths of the item's words, in whatever order.

Items with fewer than ``size`` words are one seed of all their words. Null and
empty texts match nothing. Repeated rows are reported once; equal ids with
different texts are one result row for each text. A null id stays null.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import saved
from ledgerloom.llm.texthash import (
    NOT_ALNUM, U, chunks, grams, lower_latin, mix, prefix_hash, span_hash, word_hash, words,
)

SEED_WORDS = 5
PERCENT = 50
#: log2 of the bits of the seed table: 2**23 bits are 1 MB, whatever the benchmark's size.
TABLE_BITS = 23
#: Pairs of equal seeds that a task holds at once.
PAIRS = 1 << 20


def _hashed(column: pa.Array):
    """Word hashes of runs of rows: (first row, rows, text digests, hashes, document of each)."""
    for first, last, buf, off in chunks(column):
        h = prefix_hash(buf)
        digest = mix(span_hash(h, off[:-1], off[1:]) + np.diff(off).astype(U)).view(np.int64)
        low = lower_latin(buf)
        start, end, doc = words(low, off, NOT_ALNUM)
        yield first, last - first, digest, word_hash(low, start, end), doc


def item_seeds(items: DataFrame, size: int) -> DataFrame:
    """(seed, item_id, digest, at, n): each seed of each distinct item text; n words in all."""
    schema = pa.schema([(x, pa.int64()) for x in ("seed", "item_id", "digest", "at", "n")])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, rows, digest, h, doc in _hashed(batch.column(1)):
                n = np.bincount(doc, minlength=rows)
                begin = np.cumsum(n) - n
                g, at = grams(h, doc, size)
                owner, at = doc[at], at - begin[doc[at]]
                for d in np.flatnonzero((n > 0) & (n < size)):
                    short, _ = grams(h[begin[d] : begin[d] + n[d]], np.zeros(n[d], np.int64), int(n[d]))
                    g, owner, at = np.append(g, short), np.append(owner, d), np.append(at, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.view(np.int64)), ids.take(pa.array(owner + first)), pa.array(digest[owner]),
                     pa.array(at.astype(np.int64)), pa.array(n[owner].astype(np.int64))], schema=schema,
                )

    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return items.mapInArrow(run, "seed long, item_id long, digest long, at long, n long").distinct()


def seed_table(seeds: DataFrame, bits: int = TABLE_BITS) -> np.ndarray:
    """A bit for ``seed mod 2**bits``, packed; at most 2**bits / 64 rows reach the driver."""
    slot = F.pmod(F.col("seed"), F.lit(1 << bits))
    rows = (
        seeds.select((F.floor(slot / 64)).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(seed, 64) as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("set"))
        .toPandas()
    )
    out = np.zeros(1 << max(0, bits - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["set"].to_numpy(np.int64)
    return out.view(np.uint8)


def in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    slot = h & U(8 * len(table) - 1)
    return (table[(slot >> U(3)).astype(np.int64)] >> (slot & U(7)).astype(np.uint8)) & 1 > 0


def _joined(diagonal: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of document places on a diagonal, those that touch made one."""
    order = np.lexsort((first, diagonal))
    diagonal, first, last = diagonal[order], first[order], last[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(diagonal) != 0) | (first[1:] != last[:-1] + 1)
    begin = np.flatnonzero(new)
    return diagonal[begin], first[begin], last[np.append(begin[1:], len(order))[: len(begin)] - 1]


def seed_runs(
    place: np.ndarray, seed: np.ndarray, at: np.ndarray, item_seed: np.ndarray, most: int = PAIRS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal seeds of a document and an item as stretches (diagonal, first, last place in the
    document). Places meet the item in chunks of about ``most`` pairs (one place with all of an
    item at least), so a phrase repeated in both never lies here as all its pairs."""
    order = np.argsort(place)
    place, seed = place[order], seed[order]
    order = np.argsort(item_seed)
    spots, keys = at[order], item_seed[order]
    low = np.searchsorted(keys, seed, "left")
    n = np.searchsorted(keys, seed, "right") - low
    upto = np.cumsum(n)
    parts, a = [], 0
    while a < len(place):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] - n[a] + most, "right")))
        row = np.repeat(np.arange(a, b), n[a:b])
        nth = np.arange(len(row)) - (upto[row] - n[row] - (upto[a] - n[a]))
        i = place[row]
        parts.append(_joined(i - spots[low[row] + nth], i, i))
        a = b
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    return _joined(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def tiles(pairs: np.ndarray, size: int, reach: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seed matches.

    ``pairs``: (place in the document, place in the item) of equal runs of ``reach``
    words. Returns (document, item, length) of the tiles."""
    if not len(pairs):
        return []
    p = pairs[:, 0]
    return tile_runs(*_joined(p - pairs[:, 1], p, p), size, reach)


def _room(used: set[int], ends: tuple[int, int], size: int) -> bool:
    """Whether ``size`` unmarked words in a row are left between the ends."""
    free = 0
    for j in range(*ends):
        free = 0 if j in used else free + 1
        if free >= size:
            return True
    return False


def tile_runs(diagonal: np.ndarray, first: np.ndarray, last: np.ndarray, size: int, reach: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the stretches of seeds of ``reach`` words (see ``seed_runs``)."""
    runs = zip((last - first + reach).tolist(), first.tolist(), (first - diagonal).tolist(), strict=True)
    heap = [(-n, i, j) for n, i, j in runs]
    ends = (min((j for _, _, j in heap), default=0), max((j - n for n, _, j in heap), default=0))
    heapify(heap)
    used_doc, used_item, out = set(), set(), []
    while heap:
        n, i, j = heappop(heap)
        n = -n
        free = [i + k not in used_doc and j + k not in used_item for k in range(n)]
        if all(free):
            out.append((i, j, n))
            used_doc.update(range(i, i + n))
            used_item.update(range(j, j + n))
            if not _room(used_item, ends, size):
                break
            continue
        k = 0  # what is left of it waits for its turn
        while k < n:
            if not free[k]:
                k += 1
                continue
            e = k
            while e < n and free[e]:
                e += 1
            if e - k >= size:
                heappush(heap, (k - e, i + k, j + k))
            k = e
    return out


def _lists(column: pa.Array, place: str):
    """Row -> (places, seeds) of a column of lists of structs."""
    flat, off = column.flatten(), column.offsets.to_numpy()
    off = off - off[0]
    places, seeds = (flat.field(x).to_numpy(zero_copy_only=False) for x in (place, "seed"))
    return lambda r: (places[off[r] : off[r + 1]], seeds[off[r] : off[r + 1]])


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = SEED_WORDS, percent: int = PERCENT, bits: int = TABLE_BITS
) -> DataFrame:
    """``docs(doc_id, text)``, ``items(item_id, text)`` -> doc_id, item_id, n_words (of the
    item), n_covered, n_tiles, coverage, tiles ("document:item:length" in words, by place),
    text_digest (of the document's whole text; tells apart texts with equal ids)."""
    spark = docs.sparkSession
    seeds = saved(item_seeds(items, size))
    shorter = [r.n for r in seeds.filter(F.col("n") < size).select("n").distinct().collect()]  # below ``size``
    table = spark.sparkContext.broadcast(seed_table(seeds, bits))
    schema = pa.schema([(x, pa.int64()) for x in ("seed", "doc_id", "text_digest", "place")])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, _, digest, h, doc in _hashed(batch.column(1)):
                begin = np.searchsorted(doc, np.arange(len(digest)))
                for k in (size, *shorter):
                    g, at = grams(h, doc, k)
                    hit = np.flatnonzero(in_table(table.value, g))
                    owner = doc[at[hit]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[hit].view(np.int64)), ids.take(pa.array(owner + first)), pa.array(digest[owner]),
                         pa.array((at[hit] - begin[owner]).astype(np.int64))], schema=schema,
                    )

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    hits = docs.mapInArrow(run, "seed long, doc_id long, text_digest long, place long").distinct()
    # a place meets an item once, however often its words stand there; where they stand comes with the item's text
    whose = seeds.select("seed", "item_id", F.col("digest").alias("item_digest"), "n").distinct()
    # tiles over enough of an item need at least this many places, one for each ``size`` words
    least = F.ceil(F.ceil(F.col("n") * percent / 100) / size)
    groups = ["doc_id", "text_digest", "item_id", "item_digest", "n"]
    met = hits.join(whose, "seed").groupBy(*groups).agg(F.collect_list(F.struct("place", "seed")).alias("met"))
    stand = seeds.select(F.col("digest").alias("item_digest"), "seed", "at").distinct()
    stand = stand.groupBy("item_digest").agg(F.collect_list(F.struct("at", "seed")).alias("item"))
    met = met.filter(F.size("met") >= least).join(stand, "item_digest")
    result = pa.schema([
        *((x, pa.int64()) for x in ("doc_id", "item_id", "n_words", "n_covered", "n_tiles")),
        ("tiles", pa.string()), ("text_digest", pa.int64()),
    ])

    def tile(batches):
        for batch in batches:
            out = []
            met, item = (_lists(batch.column(c), x) for c, x in (("met", "place"), ("item", "at")))
            for r, row in enumerate(batch.select(groups).to_pylist()):
                n, k = row["n"], min(size, row["n"])
                found = sorted(tile_runs(*seed_runs(*met(r), *item(r)), k, k))
                covered = sum(x[2] for x in found)
                if 100 * covered >= percent * n:
                    spans = ",".join(f"{i}:{j}:{m}" for i, j, m in found)
                    out.append((row["doc_id"], row["item_id"], n, covered, len(found), spans, row["text_digest"]))
            columns = list(zip(*out, strict=True)) or [[] for _ in result]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, result, strict=True)], schema=result)

    found = met.mapInArrow(
        tile, "doc_id long, item_id long, n_words long, n_covered long, n_tiles long, tiles string, text_digest long"
    )
    return found.withColumn("coverage", F.col("n_covered") / F.col("n_words")).distinct()
