"""Vectorised hashing of whole texts inside Arrow tasks.

Texts of an Arrow batch lie one after the other in one byte buffer, so bytes,
words and n-grams of many documents are hashed by a few numpy passes without
making Python strings. A chunk holds whole documents, about ``CHUNK`` bytes (one
document larger than that is a chunk of its own), which bounds a task's memory
by the longest document.

The hash of ``buf[i:j]`` is polynomial modulo 2**64 over a random table of byte
values: ``(H[j] - H[i]) * B**-i`` with one running prefix sum ``H``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1_000_000
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U) * U(_BASE))

#: Byte classes. Blank: space and \t \n \v \f \r. Letters: A-Z a-z 0-9 and all of a multi-byte character.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@lru_cache(maxsize=2)
def _power_table(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, dtype=U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i <= n (tables grow by doubling)."""
    size = 1 << max(20, int(n + 1).bit_length())
    return _power_table(size, _BASE), _power_table(size, _INVERSE)


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        yield first, last, data[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """H with ``len(buf) + 1`` entries."""
    out = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(_BYTES[buf] * powers(len(buf))[0][: len(buf)], dtype=U, out=out[1:])
    return out


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (h[end] - h[start]) * powers(len(h))[1][start]


def lower_latin(buf: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals to small letters, length kept."""
    out = LOWER[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3) if len(buf) > 1 else np.zeros(0, np.int64)
    tail = buf[lead + 1]
    up = lead[(tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)] + 1
    out[up] += 32
    return out


def words(buf: np.ndarray, off: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each word: a maximal run of bytes that are no separators, within one document."""
    n = len(buf)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separator[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return start, end, np.searchsorted(off, start, "right") - 1


def word_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(span_hash(prefix_hash(buf), start, end) + (end - start).astype(U))


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every k consecutive words of one document."""
    if len(hashes) < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :])
    total = np.zeros(len(at), U)
    for j in range(k):
        total = total * U(_BASE) + hashes[at + j]
    return mix(total), at


class Dealer:
    """Packs parallel arrays into one binary row per bucket, so that a shuffle
    moves blocks instead of millions of small rows. ``add`` deals entries out;
    ``flush`` gives the rows gathered so far."""

    def __init__(self, buckets: int, limit: int = 600_000):
        self.buckets, self.limit, self.held, self.parts = buckets, limit, 0, []

    def add(self, key: np.ndarray, *columns: np.ndarray) -> None:
        self.parts.append(((key % U(self.buckets)).astype(np.int32), *columns))
        self.held += len(key)

    @property
    def full(self) -> bool:
        return self.held >= self.limit

    def flush(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        bucket, *columns = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        order = np.argsort(bucket, kind="stable")
        found, first = np.unique(bucket[order], return_index=True)
        last = [*first[1:], len(order)]
        out = [pa.array(found, pa.int32())]
        for c in columns:
            c = c[order]
            out.append(pa.array([c[i:j].tobytes() for i, j in zip(first, last, strict=True)], pa.binary()))
        yield pa.RecordBatch.from_arrays(out, schema=schema)


def gather(batches: Iterator[pa.RecordBatch], dtypes: list) -> Iterator[list[np.ndarray]]:
    """The arrays of each bucket of a partition dealt by bucket and sorted by it (first column)."""
    bucket, parts = None, []
    for batch in batches:
        found = batch.column(0).to_pylist()
        columns = [batch.column(i + 1) for i in range(len(dtypes))]
        for row, b in enumerate(found):
            if b != bucket and parts:
                yield [np.concatenate(x) for x in zip(*parts, strict=True)]
                parts = []
            bucket = b
            parts.append([np.frombuffer(c[row].as_py(), dtype=t) for c, t in zip(columns, dtypes, strict=True)])
    if parts:
        yield [np.concatenate(x) for x in zip(*parts, strict=True)]


def buckets_of(spark) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
