"""Periodic runs of words in whole texts, found along sparse diagonals.

A run is a maximal stretch of words with smallest period q that is at least
``MIN_WORDS`` words and ``MIN_TIMES`` periods long. Word i lies on the diagonal of lag p
if it equals word i - p; a run of period p is a stretch of that diagonal of
``max(MIN_WORDS - p, (MIN_TIMES - 1) * p)`` words or more.

Words go through the diagonals in order: an earlier occurrence of word i (with the words that
follow it) at lag p continues the match length of lag p if word i - 1 was on it, else it begins a
new one; a diagonal that is not continued ends, and is a run if it is long enough. What keeps
the diagonals few, with nothing lost:

* lags are taken in bands [b, 2b), and a word counts with the ``max(16, 2b)`` words that begin at
  it: no run of such a lag is shorter than that along its diagonal;
* of a word's earlier occurrences in a band only the farthest is followed. If a nearer one, at
  lag p, were on a run of smallest period p, both lags would be periods of the words that
  begin here, their greatest common divisor as well (Fine and Wilf), and it would be a smaller
  period of the whole run.

So a text of n words has O(n log n) cells, also where all its words are equal. Diagonals of lags
that are no smallest period may be followed in parts; they end inside a longer stretch or have
the same bounds as the smallest period, and both are dropped.

Words are compared by 64-bit hashes; the words of every run found are compared as bytes, and a
text where that fails is searched again by numbers of its different words. Work is by
document, in chunks bounded by the longest text. Null and empty texts have no words and no
runs; repeated rows give the same row again; an empty table gives no rows; other columns do
not matter. A null id is not damaged by ``damage``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cmp_to_key
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texthash import BLANK, U, chunks, mix, powers, word_hash, words

MIN_WORDS = 24
MIN_TIMES = 3
#: Words of the shortest diagonal: max(MIN_WORDS - p, (MIN_TIMES - 1) * p) is least at p = 8.
SHORTEST = 16


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that begin at each word (the last ones have none)."""
    up, down = powers(len(h))
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * up[: len(h)], dtype=U, out=total[1:])
    return mix((total[size:] - total[:-size]) * down[: len(h) - size + 1])


def _cells(key: np.ndarray, at: np.ndarray, group: np.ndarray, low: int, width: int) -> np.ndarray:
    """lag * width + word of the farthest earlier occurrence at a lag in [low, 2 * low) of each word in
    ``at``; ``key`` is group * width + word, ascending."""
    first = np.searchsorted(key, group * width + np.maximum(at - 2 * low + 1, 0))
    near = group * width + at - low
    met = (at >= low) & (key[np.minimum(first, len(key) - 1)] <= near) & (first < len(key))
    return (at - (key[np.minimum(first, len(key) - 1)] - group * width))[met] * width + at[met]


def find_runs(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs in the words of hash ``h``; ``doc`` numbers their documents, ascending."""
    width = len(h) + 1
    found = []
    live = np.arange(len(h))
    low = size = 1
    longest = int(np.bincount(doc).max()) if len(doc) else 0
    while len(live) and low * MIN_TIMES <= longest:
        grown = max(SHORTEST, 2 * low)
        if grown != size:
            size = grown
            live = live[live + size <= len(h)]
            live = live[doc[live] == doc[live + size - 1]]
            if not len(live):
                break
            # words that begin the same ``size`` words in one document; those without a second one are done
            gram = mix(_gram_hashes(h, size)[live] + doc[live].astype(U))
            order = np.argsort(gram, kind="stable")
            gram, at = gram[order], live[order]
            new = np.ones(len(at), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (doc[at[1:]] != doc[at[:-1]])
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            keep = (at[last] - at[first] >= low)[group]
            at, group = at[keep], group[keep]
            live = np.sort(at)
            key = group * width + at
        if len(live):
            found.append((_cells(key, at, group, low, width), size))
        low *= 2
    parts = [_diagonals(np.unique(cells), size, width) for cells, size in found if len(cells)]
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = (np.concatenate(x) for x in zip(*parts, strict=True))
    return _whole(h, doc, start, end, period)


def _diagonals(cells: np.ndarray, size: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Match lengths along each lag: a cell continues the one of the word before; those that end long enough."""
    ends = np.flatnonzero(np.append(np.diff(cells) != 1, True))
    begins = np.append(0, ends[:-1] + 1)
    lag, word = cells[begins] // width, cells[begins] % width
    start, end = word - lag, word + (ends - begins) + size
    enough = end - start >= np.maximum(MIN_WORDS, MIN_TIMES * lag)
    return start[enough], end[enough], lag[enough]


def _whole(h, doc, start, end, period):
    """Stretches that no neighbouring word continues, each with its smallest period."""
    left = start - 1
    more = (left >= 0) & (doc[left] == doc[start]) & (h[left] == h[left + period])
    right = np.minimum(end, len(h) - 1)
    more |= (end < len(h)) & (doc[right] == doc[start]) & (h[right] == h[right - period])
    start, end, period = start[~more], end[~more], period[~more]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def _exact(tokens: list[bytes]) -> list[Run]:
    """The runs of one text from numbers of its different words instead of hashes."""
    numbers: dict[bytes, int] = {}
    h = np.array([numbers.setdefault(t, len(numbers) + 1) for t in tokens], U)
    # distinct numbers stay distinct under mix, which is a bijection
    start, end, period = find_runs(mix(h), np.zeros(len(h), np.int64))
    return [Run(s, e - s, p) for s, e, p in zip(start.tolist(), end.tolist(), period.tolist(), strict=True)]


def runs_of(tokens: list[bytes], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> list[Run]:
    """The runs found by hashes, when the words themselves agree."""
    out = []
    for s, e, p in zip(start.tolist(), end.tolist(), period.tolist(), strict=True):
        if tokens[s + p : e] != tokens[s : e - p]:
            return _exact(tokens)
        out.append(Run(s, e - s, p))
    return sorted(out, key=lambda r: (r.start, r.period))


def kept_words(tokens: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside runs and those of each run's first period."""
    if not runs:
        return tokens
    edge = np.zeros(len(tokens) + 1, np.int64)
    for run in runs:
        edge[run.start + run.period] += 1
        edge[run.start + run.length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [tokens[i] for i in np.flatnonzero(keep).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exact length / period; ties: smallest start, then period."""

    def order(a: Run, b: Run) -> int:
        return b.length * a.period - a.length * b.period or a.start - b.start or a.period - b.period

    return min(runs, key=cmp_to_key(order), default=None)


def damage(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) from which a tenth of the documents repeat themselves; None for the others."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _damaged(ids: list, off: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Which original word stands at each place of a chunk, ``off`` being each document's first word."""
    source = np.arange(int(n_words.sum()))
    for doc_id, begin, n in zip(ids, off.tolist(), n_words.tolist(), strict=True):
        if (hit := damage(doc_id, n)) is not None:
            a, p = hit
            source[begin + a : begin + n] = begin + a + np.arange(n - a) % p
    return source


FIELDS = (
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
)


def _search(batches: Iterator[pa.RecordBatch], damaged: bool):
    """(row of the batch, batch, words, runs) of every text."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for first, last, buf, off in chunks(batch.column(1)):
            begin, end, doc = words(buf, off, BLANK)
            h = word_hash(buf, begin, end)
            n = np.bincount(doc, minlength=last - first)
            where = np.cumsum(n) - n
            source = _damaged(ids[first:last], where, n) if damaged else np.arange(len(h))
            found = find_runs(h[source], doc)
            owner = doc[found[0]]
            data = buf.tobytes()
            bounds = np.searchsorted(owner, np.arange(last - first + 1))
            for k in range(last - first):
                tokens = data[off[k] : off[k + 1]].split()
                w = int(where[k])
                if damaged and (hit := damage(ids[first + k], len(tokens))) is not None:
                    a, p = hit
                    tokens = tokens[:a] + [tokens[a + i % p] for i in range(len(tokens) - a)]
                mine = slice(int(bounds[k]), int(bounds[k + 1]))
                yield ids[first + k], tokens, runs_of(tokens, found[0][mine] - w, found[1][mine] - w, found[2][mine])


def digests(docs: DataFrame, damaged: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> one row for each: the number of runs, the strongest one, digests of all
    runs and of the text without what they repeat. ``damaged`` first makes a tenth of them periodic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(x, t) for x, (_, t) in zip(zip(*rows, strict=True), FIELDS, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in FIELDS])

        for doc_id, tokens, runs in _search(batches, damaged):
            best = strongest(runs)
            top = (None,) * 4 if best is None else (*best, 1000 * best.length // best.period)
            written = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
            kept = b" ".join(kept_words(tokens, runs))
            rows.append((doc_id, len(runs), *top, hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
            if len(rows) >= 1000:
                yield flush()
        if rows:
            yield flush()

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def collapse(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, text, runs): the words joined by single spaces without what runs
    repeat, and the runs as (start, length, period)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(f, pa.int64()) for f in Run._fields]))
        for doc_id, tokens, runs in _search(batches, damaged=False):
            text = b" ".join(kept_words(tokens, runs)).decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id], pa.int64()), pa.array([text]), pa.array([[r._asdict() for r in runs]], kind)],
                names=["doc_id", "text", "runs"],
            )

    schema = "doc_id long, text string, runs array<struct<start:long, length:long, period:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
