"""Removal of long repeated substrings by a hash-compared suffix sort.

Every byte covered by a string of ``length`` bytes that also starts anywhere else in
the corpus goes. Suffixes are put in order by a merge sort whose comparison finds their longest
common extension by binary search on prefix polynomial hashes (the hash of any span is one
subtraction) and then compares one byte. The order is verified: the bytes of all neighbours are
compared, and where a collision has spoiled it the suffixes are ordered by their bytes. Neighbours
that agree in ``length`` bytes repeat. Only suffixes that can matter are sorted:

1. Exact copies are classes by a 64-bit hash that is checked against SHA-256 over the whole table
   (and drawn anew, with another seed, if two texts share one); they go whole, one of each goes on.
2. Each window of ``length`` bytes is assigned to its *anchor*, the ``GRAM``-byte string in
   it with the smallest hash (the leftmost of equals). Equal windows have equal
   anchors at equal places. The windows of one anchor start next to each other; the
   bytes that they cover are its *hull*. Anchors are dealt out by their hash in packed
   blocks. One that occurs once has no repeated window. Hulls with equal 128-bit BLAKE2 digests of
   their bytes repeat whole.
3. For anchors that occur again with another hull (the edges of repeated passages),
   hulls meet by anchor, and the suffixes at their windows are sorted. An anchor with
   more than ``HOT`` hulls is cut into slices of neighbouring windows that meet by the
   bytes all windows of the slice share; equal hulls meet as one with a list of places.
4. The spans found are united for each document and cut out of its bytes.

Null texts are empty; texts below ``length`` bytes lose nothing. Repeated rows are
documents of their own, and so are rows with equal or null ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import observed, saved
from ledgerloom.llm.texthash import U, Dealer, buckets_of, chunks, gather, mix, prefix_hash, span_hash

LENGTH = 400
GRAM = 50
HOT = 4096
SLICE = 32
#: Bytes of hulls that are sorted at once, or those of one key if that has more.
SOLVED = 1_000_000
_EMPTY = hashlib.sha256(b"").hexdigest()


def anchors(buf: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(prefix hashes, document, anchor, first and last window start, anchor hash) of a chunk."""
    h = prefix_hash(buf)
    n, reach = len(buf), length - gram + 1
    none = np.zeros(0, np.int64)
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(off, off[1:], strict=False) if b - a >= length] or [none])
    if not len(starts):
        return h, none, none, none, none, np.zeros(0, U)
    at = np.arange(n - gram + 1)
    key = mix(span_hash(h, at, at + gram))
    low = U((1 << 32) - 1)
    value = (key & ~low) | at.astype(U)
    # least of every ``reach`` values: running minima within blocks, forwards and backwards
    pad = (-len(value)) % reach
    block = np.concatenate([value, np.full(pad, ~U(0))]).reshape(-1, reach)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(back[starts], ahead[starts + reach - 1]) & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)]))
    s1, s2, a = starts[new], starts[np.append(new[1:], len(starts)) - 1], anchor[new]
    doc = np.searchsorted(off, a, "right") - 1
    return h, doc, a, s1, s2, key[a]


def hull_digests(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128 bits of BLAKE2 of each span of bytes, as two columns."""
    spans = zip(start.tolist(), end.tolist(), strict=True)
    return np.frombuffer(b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in spans), U).reshape(-1, 2)


def extension(h: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the longest common extension of the suffixes at i and j, ``most`` at most, by binary search."""
    low, high = np.zeros(len(i), np.int64), most.astype(np.int64).copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = span_hash(h, i, i + mid) == span_hash(h, j, j + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def less(buf: np.ndarray, h: np.ndarray, i: np.ndarray, j: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the suffix at i comes before, and whether it is equal to, that at j in their first ``length`` bytes."""
    run = extension(h, i, j, np.full(len(i), length))
    equal = run == length
    at = np.where(equal, 0, run)
    return ~equal & (buf[i + at] < buf[j + at]), equal


def suffix_order(buf: np.ndarray, h: np.ndarray, start: np.ndarray, part: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes at ``start`` within each part (``part`` ascending), by merge sort.

    All parts are sorted together: in each round runs of ``width`` suffixes are merged in pairs, and a suffix
    finds its place in the other run by binary search with ``less``."""
    n = len(start)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    size = np.diff(np.append(first, n))
    base, count = np.repeat(first, size), np.repeat(size, size)
    place = np.arange(n) - base
    order, width = np.arange(n), 1
    while width < size.max():
        run = place // width
        other = run ^ 1
        low = other * width
        there = low < count  # the last run of a part can be alone
        high = np.where(there, np.minimum(low + width, count), low)
        low, left = low.copy(), run % 2 == 0
        open_ = np.flatnonzero(low < high)
        lo, hi = low.copy(), high.copy()
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            mine, theirs = start[order[open_]], start[order[base[open_] + mid]]
            before, equal = less(buf, h, theirs, mine, length)
            # what is equal in the left run stays in front
            behind = before | (equal & ~left[open_])
            lo[open_] = np.where(behind, mid + 1, lo[open_])
            hi[open_] = np.where(behind, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        pair = (run // 2) * 2 * width
        new = base + np.where(there, pair + (place - run * width) + (lo - low), place)
        moved = np.full_like(order, -1)
        moved[new] = order
        if (moved < 0).any():  # comparisons that contradict each other: a collision, which is found when the order is verified
            return np.arange(n)
        order, width = moved, 2 * width
    return order


def in_order(buf: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the bytes at a are less than, and whether they equal, those at b; compared byte by byte."""
    before, equal = np.zeros(len(a), bool), np.zeros(len(a), bool)
    windows = np.lib.stride_tricks.sliding_window_view(buf, length)
    step = max(1, 4_000_000 // length)
    for k in range(0, len(a), step):
        x, y = windows[a[k : k + step]], windows[b[k : k + step]]
        differ = x != y
        at = differ.argmax(axis=1)
        rows = np.arange(len(x))
        equal[k : k + step] = ~differ[rows, at]
        before[k : k + step] = x[rows, at] < y[rows, at]
    return before, equal


def repeated(hulls: list[bytes], groups: np.ndarray, lead: np.ndarray, windows: np.ndarray, length: int = LENGTH):
    """(hull, start, end) of what repeats among different hulls of a group.

    ``lead``: how far the anchor lies behind a hull's first window; ``windows``: how many it has.
    Suffixes are compared with those that start as far before the anchor."""
    buf = np.frombuffer(b"".join(hulls), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in hulls])])
    hull = np.repeat(np.arange(len(hulls)), windows)
    t = np.arange(len(hull)) - np.repeat(np.cumsum(windows) - windows, windows)
    part = mix(groups[hull].view(U) + (lead[hull] - t).astype(U))
    sort = np.argsort(part, kind="stable")
    hull, t, part = hull[sort], t[sort], part[sort]
    # a suffix that is alone in its part repeats nothing
    new = part[1:] != part[:-1]
    alone = np.concatenate([[True], new]) & np.concatenate([new, [True]])
    hull, t, part = hull[~alone], t[~alone], part[~alone]
    if not len(hull):
        return []
    start = off[hull] + t
    order = suffix_order(buf, prefix_hash(buf), start, part, length)
    inside = part[1:] == part[:-1]
    before, equal = in_order(buf, start[order[:-1]], start[order[1:]], length)
    if (inside & ~before & ~equal).any():  # a collision
        raw = buf.tobytes()
        order = np.array(sorted(range(len(start)), key=lambda k: (part[k], raw[start[k] : start[k] + length])))
        before, equal = in_order(buf, start[order[:-1]], start[order[1:]], length)
    equal &= inside
    found = np.zeros(len(start), bool)
    found[order[:-1][equal]] = found[order[1:][equal]] = True
    hull, t = hull[found], t[found]
    # windows in a row are one span
    sort = np.lexsort((t, hull))
    hull, t = hull[sort], t[sort]
    ends = np.flatnonzero(np.append((np.diff(hull) != 0) | (np.diff(t) != 1), True)) if len(hull) else np.zeros(0, np.int64)
    begins = np.append(0, ends[:-1] + 1) if len(ends) else ends
    return [(int(hull[b]), int(t[b]), int(t[e]) + length) for b, e in zip(begins, ends, strict=True)]


def _entries(docs: DataFrame, buckets: int, length: int) -> DataFrame:
    schema = pa.schema([("bucket", pa.int32()), *((x, pa.binary()) for x in ("key", "cls", "place", "lead", "tail", "d1", "d2"))])

    def run(batches):
        out = Dealer(buckets)
        for batch in batches:
            cls = batch.column(0).to_numpy()
            for first, last, buf, off in chunks(batch.column(1)):
                _, doc, a, s1, s2, key = anchors(buf, off, length)
                _, lead = np.unique(cls[first:last], return_index=True)  # copies in one run are dealt out once
                keep = np.isin(doc, lead)
                a, s1, s2, doc = (x[keep] for x in (a, s1, s2, doc))
                key, digest = key[keep], hull_digests(buf.tobytes(), s1, s2 + length)
                out.add(
                    key, key, cls[first + doc], (a - off[doc]).astype(np.int32), (a - s1).astype(np.int16), (a - s2).astype(np.int16),
                    digest[:, 0], digest[:, 1],
                )
                if out.full:
                    yield from out.flush(schema)
        yield from out.flush(schema)

    return docs.mapInArrow(run, "bucket int, key binary, cls binary, place binary, lead binary, tail binary, d1 binary, d2 binary")


def _met(entries: DataFrame, buckets: int, most: int) -> DataFrame:
    """Spans whose hull repeats whole, and hulls to be compared (key not 0), packed by document."""
    schema = pa.schema([("bucket", pa.int32()), *((x, pa.binary()) for x in ("cls", "key", "place", "lead", "tail", "hot"))])

    def run(batches):
        out = Dealer(buckets)
        for key, cls, place, lead, tail, d1, d2 in gather(batches, [U, np.int64, np.int32, np.int16, np.int16, U, U]):
            order = np.lexsort((place, cls, d2, d1, tail, lead, key))
            key, cls, place, lead, tail, d1, d2 = (x[order] for x in (key, cls, place, lead, tail, d1, d2))
            new = lambda *c: np.concatenate([[True], np.any([x[1:] != x[:-1] for x in c], axis=0)])
            once = new(key, cls, place)
            key, cls, place, lead, tail, d1, d2 = (x[once] for x in (key, cls, place, lead, tail, d1, d2))
            at = np.flatnonzero(new(key, lead, tail, d1, d2))
            size = np.diff(np.append(at, len(key)))  # places of each hull
            by_key = np.flatnonzero(new(key[at]))
            hulls = np.diff(np.append(by_key, len(at)))  # hulls of each key
            hulls_of = np.repeat(hulls, hulls)  # for each hull
            whole = np.repeat(size > 1, size)
            none = np.zeros(whole.sum(), U)
            out.add(mix(cls[whole].view(U)), cls[whole], none, place[whole], lead[whole], tail[whole], none.astype(np.int8))
            # compared are the hulls of keys that have several, each at one of its places
            # (a hull that repeats whole is still what others may match)
            one = at[hulls_of > 1]
            hot = (hulls_of[hulls_of > 1] > most).astype(np.int8)
            out.add(mix(cls[one].view(U)), cls[one], key[one], place[one], lead[one], tail[one], hot)
            if out.full:
                yield from out.flush(schema)
        yield from out.flush(schema)

    return entries.mapInArrow(run, "bucket int, cls binary, key binary, place binary, lead binary, tail binary, hot binary")


def _by_document(met: DataFrame, length: int) -> DataFrame:
    """One row for each class: the spans known, united, and the hulls asked for."""
    names = ("spans", "key", "place", "lead", "tail", "hot")
    schema = pa.schema([("cls", pa.int64()), *((x, pa.binary()) for x in names)])

    def run(batches):
        for cls, key, place, lead, tail, hot in gather(batches, [np.int64, U, np.int32, np.int16, np.int16, np.int8]):
            order = np.lexsort((place, cls))
            cls, key, place, lead, tail, hot = (x[order] for x in (cls, key, place, lead, tail, hot))
            first = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
            rows = []
            for i, j in zip(first, np.append(first[1:], len(cls)), strict=True):
                known, ask = key[i:j] == 0, key[i:j] != 0
                s = place[i:j][known].astype(np.int64)
                spans = unite(np.stack([s - lead[i:j][known], s - tail[i:j][known] + length], axis=1))
                rows.append((int(cls[i]), spans.tobytes(), *(x[i:j][ask].tobytes() for x in (key, place, lead, tail, hot))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return met.mapInArrow(run, "cls long, spans binary, key binary, place binary, lead binary, tail binary, hot binary")


def unite(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of touching or overlapping (start, end), by start."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")].astype(np.int64)
    end = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > end[:-1]]))
    return np.stack([spans[first, 0], end[np.append(first[1:], len(spans)) - 1]], axis=1)


def _hulls(texts: DataFrame, length: int) -> DataFrame:
    """(key, hull, lead, windows, cls, start): hulls asked for, hot ones in slices."""
    schema = pa.schema([
        ("key", pa.int64()), ("hull", pa.binary()), ("lead", pa.int32()), ("windows", pa.int32()), ("cls", pa.int64()), ("start", pa.int32())
    ])

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                key = np.frombuffer(row["key"], U)
                if not len(key):
                    continue
                raw = row["text"].encode()
                place, lead, tail = (np.frombuffer(row[x], t).astype(int) for x, t in (("place", np.int32), ("lead", np.int16), ("tail", np.int16)))
                hot = np.frombuffer(row["hot"], np.int8)
                h = prefix_hash(np.frombuffer(raw, np.uint8)) if hot.any() else None
                for k, p, a, b, many in zip(key, place, lead, tail, hot, strict=True):
                    if not many:
                        rows.append((int(k.view(np.int64)), raw[p - a : p - b + length], a, a - b + 1, row["cls"], p - a))
                        continue
                    for n in range(b // SLICE, a // SLICE + 1):
                        # windows that start n * SLICE to (n + 1) * SLICE - 1 before the anchor, as far as they are its own
                        core = span_hash(h, np.array([p - n * SLICE]), np.array([p - (n + 1) * SLICE + 1 + length]))
                        sub = mix(core ^ mix(np.array([k]) + U(n)))[0]
                        x, y = min(a, (n + 1) * SLICE - 1), max(b, n * SLICE)
                        rows.append((int(sub.view(np.int64)), raw[p - x : p - y + length], x, x - y + 1, row["cls"], p - x))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return texts.mapInArrow(run, "key long, hull binary, lead int, windows int, cls long, start int")


def _compared(hulls: DataFrame, length: int) -> DataFrame:
    """(cls, spans) of the hulls that meet in a partition dealt and sorted by key."""
    schema = pa.schema([("cls", pa.int64()), ("spans", pa.binary())])

    def solve(rows):
        seen: dict[tuple, int] = {}
        places: list[set] = []
        for key, hull, lead, windows, cls, start in rows:
            i = seen.setdefault((key, lead, windows, hull), len(places))
            if i == len(places):
                places.append(set())
            places[i].add((cls, start))
        found: dict[int, list] = {}
        single = list(seen)
        for (_, _, windows, _), own in zip(single, places, strict=True):
            if len(own) > 1:  # one hull in several places repeats whole
                for cls, start in own:
                    found.setdefault(cls, []).append((start, start + windows - 1 + length))
        keys, lead, windows, hull = (list(x) for x in zip(*single, strict=True))
        for i, a, b in repeated(hull, np.array(keys, np.int64), np.array(lead), np.array(windows), length):
            for cls, start in places[i]:
                found.setdefault(cls, []).append((start + a, start + b))
        rows = [(cls, unite(np.array(s)).tobytes()) for cls, s in found.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > SOLVED and row[0] != held[-1][0]:  # between two keys
                    yield from solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            yield from solve(held)

    return hulls.mapInArrow(run, "cls long, spans binary")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their class, their sizes and SHA-256, and the classes (copies, smallest id): a class is one text."""
    seed = 0
    while True:
        classed = docs.withColumn("cls", F.xxhash64("text", F.lit(seed)))
        slim = saved(classed.select("doc_id", "cls", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
        found = slim.groupBy("cls").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("first"), (F.min("sha") != F.max("sha")).alias("mixed")
        )
        classes, seen = observed(found, F.coalesce(F.bool_or("mixed"), F.lit(False)).alias("mixed"))
        if not seen["mixed"]:
            return classed, slim, classes.drop("mixed")
        seed += 1


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 (of the remaining bytes), kept (those bytes; null if all are kept)."""
    if not GRAM <= length <= 32_000:
        raise ValueError(f"length must be {GRAM} to 32000 bytes")
    buckets = buckets_of(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    docs, slim, classes = _classes(docs)
    long_docs = docs.filter(F.octet_length("text") >= length)

    entries = _entries(long_docs.select("cls", "text"), buckets, length).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    met = _met(entries, buckets, hot).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    asked = saved(_by_document(met, length))

    # texts with candidates, one of each class: its copies are dealt out by their ids
    wanted = asked.join(classes, "cls").withColumnRenamed("cls", "_cls")
    texts = long_docs.join(wanted, (F.col("cls") == F.col("_cls")) & F.col("doc_id").eqNullSafe(F.col("first"))).drop("_cls", "first")
    texts = saved(texts.dropDuplicates(["cls"]))

    hulls = _hulls(texts.select("cls", "text", "key", "place", "lead", "tail", "hot"), length)
    compared = _compared(hulls.repartition(buckets, "key").sortWithinPartitions("key"), length)
    spans = compared.unionByName(asked.select("cls", "spans")).filter(F.length("spans") > 0)
    spans = spans.groupBy("cls").agg(F.collect_list("spans").alias("parts"))  # bounded by the document
    schema = pa.schema([
        ("cls", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())
    ])

    def cut(batches):
        for batch in batches:
            rows = []
            for cls, raw, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = raw.encode()
                gone = unite(np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 2) for p in parts]))
                edges = [0, *gone.ravel().tolist(), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((cls, len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [[]] * 5, schema, strict=True)], schema=schema)

    single = texts.filter("copies = 1").select("cls", "text").join(spans, "cls")
    changed = single.select("cls", "text", "parts").mapInArrow(cut, "cls long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = slim.join(classes.select("cls", "copies"), "cls").join(changed, "cls", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return out.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
        F.when(gone, F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
