"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of the
words that occur in it; a document's score is the noisy-or of its sentences,
``1 - prod(1 - p)``. Only document labels are known, so the weights are fitted by
the likelihood of the noisy-or (Adam, full batches), which hands the blame to the
sentences that explain the label. The fitted sentence scores then locate the
offending sentences.

The model is fitted on a bounded sample: at most ``max_rows`` labelled documents,
the first by the hash of their id, each with its whole text.

Null and empty texts have no sentence and get the score of an empty bag, 0.
Repeated rows each get their row. A label that is null teaches nothing; of several
labels of one document the largest counts.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texthash import NOT_ALNUM, U, chunks, lower_latin, mix, word_hash, words

WORD_BITS = 22
STEM = 4
MAX_ROWS = 6_000
THRESHOLD = 0.3

#: A sentence ends behind each of these.
ENDS = np.zeros(256, bool)
ENDS[[ord("."), ord("!"), ord("?"), ord("\n")]] = True


def instances(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a chunk: (sentence, word slot) pairs without repeats; document, start and end byte of every sentence."""
    low = lower_latin(buf)
    start, end, doc = words(low, off, NOT_ALNUM)
    # a word, and its first bytes for forms not seen before
    slot = np.concatenate([word_hash(low, start, end), ~word_hash(low, start, np.minimum(start + STEM, end))])
    slot = (slot >> U(64 - WORD_BITS)).astype(np.int64)
    cut = np.zeros(len(buf) + 1, bool)
    cut[1:][ENDS[buf]] = True
    cut[off] = True
    place = np.flatnonzero(cut)
    sentence = np.searchsorted(place, start, "right") - 1
    used, sentence = np.unique(sentence, return_inverse=True)  # those that have words
    first = np.searchsorted(sentence, np.arange(len(used)))
    pair = np.unique(np.concatenate([sentence, sentence]) << WORD_BITS | slot)
    return pair >> WORD_BITS, pair & ((1 << WORD_BITS) - 1), doc[first], place[used], place[used + 1] if len(used) else place[:0]


@dataclass
class SentenceModel:
    weight: np.ndarray
    bias: float

    def logits(self, sentence: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(sentence, weights=self.weight[slot], minlength=n) + self.bias


def _noisy_or(logit: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """log prod(1 - p) of each document."""
    return -np.bincount(doc, weights=np.logaddexp(0, logit), minlength=n)


def _frequent(sentence: np.ndarray, slot: np.ndarray, least: int) -> np.ndarray:
    """Which pairs are of slots that occur in ``least`` different sentences: the words of one
    sentence that copies repeat are one observation."""
    total = np.concatenate([[U(0)], np.cumsum(mix(slot.astype(U) + U(1)), dtype=U)])
    first = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
    last = np.append(first[1:], len(sentence))
    sign = np.repeat(total[last] - total[first], last - first)
    order = np.lexsort((sign, slot))
    x, y = slot[order], sign[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    found, n = np.unique(x[new], return_counts=True)
    return n[np.searchsorted(found, slot)] >= least


def fit_bags(
    sentence: np.ndarray, slot: np.ndarray, doc: np.ndarray, label: np.ndarray,
    steps: int = 200, rate: float = 0.15, penalty: float = 5e-6, least: int = 4,
) -> SentenceModel:
    """Weights from bags: (sentence, slot) pairs by sentence, the document of each sentence, the label of each document."""
    weight = np.zeros(1 << WORD_BITS, np.float32)
    if not len(label) or not len(slot):
        return SentenceModel(weight, -8.0)
    keep = _frequent(sentence, slot, least)
    sentence, slot = sentence[keep], slot[keep]
    slots, column = np.unique(slot, return_inverse=True)
    n_sentence, n = len(doc), len(label)
    # start: words of toxic documents that others lack
    in_doc = np.unique(doc[sentence] * len(slots) + column) if len(slots) else column
    has = np.bincount(in_doc % max(1, len(slots)), minlength=len(slots))
    toxic = np.bincount(in_doc % max(1, len(slots)), weights=label[in_doc // max(1, len(slots))], minlength=len(slots))
    base = (label.sum() + 1) / (n + 2)
    w = np.clip(np.log((toxic + 2 * base) / (has - toxic + 2 * (1 - base))) - np.log(base / (1 - base)), 0, 6)
    w, b = np.where(w > 1, w, 0.0), -8.0
    m, v = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)
    for t in range(1, steps + 1):
        z = np.bincount(sentence, weights=w[column], minlength=n_sentence) + b
        p = 1 / (1 + np.exp(-z))
        none = _noisy_or(z, doc, n)
        some = np.maximum(-np.expm1(none), 1e-9)
        # d log-likelihood / d z of each sentence
        gain = np.where(label > 0, np.exp(none) / some, -1.0)[doc] * p
        step = np.append(np.bincount(column, weights=gain[sentence], minlength=len(slots)) / n - penalty * w, gain.sum() / n)
        m, v = 0.9 * m + 0.1 * step, 0.99 * v + 0.01 * step * step
        move = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w + move[:-1], min(b + move[-1], -1.0)
    weight[slots] = w
    return SentenceModel(weight, float(b))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> SentenceModel:
    """``docs(doc_id, text)``, ``labels(doc_id, toxic)`` -> model, fitted by one task on the bounded sample."""
    key = F.struct(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(key).limit(max_rows)  # the bound of the sample
    bags = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("sentence", pa.binary()), ("slot", pa.binary())])

    def read(batches):
        for batch in batches:
            for first, last, buf, off in chunks(batch.column(1)):
                sentence, slot, doc, _, _ = instances(buf, off)
                of = doc[sentence] if len(doc) else doc
                begin = np.searchsorted(of, np.arange(last - first + 1))
                rows = [(sentence[i:j].astype(np.int32).tobytes(), slot[i:j].astype(np.int32).tobytes()) for i, j in zip(begin, begin[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(2).slice(first, last - first).cast(pa.int32()),
                     pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], schema=schema,
                )

    def train(batches):
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: (r[0], r[2], r[3]))
        sentence, slot, doc, label, n = [], [], [], [], 0
        for i, (_, toxic, s, w) in enumerate(rows):
            s = np.frombuffer(s, np.int32).astype(np.int64)
            own, s = np.unique(s, return_inverse=True)
            sentence.append(s + n)
            slot.append(np.frombuffer(w, np.int32).astype(np.int64))
            doc.append(np.full(len(own), i))
            label.append(float(toxic > 0))
            n += len(own)
        parts = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sentence, slot, doc)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_bags(*parts, np.array(label)))], pa.binary())], names=["model"])

    found = (
        bags.select("doc_id", "text", "toxic").mapInArrow(read, "doc_id long, toxic int, sentence binary, slot binary")
        .repartition(1).mapInArrow(train, "model binary").collect()
    )
    return pickle.loads(found[0].model) if found else fit_bags(*[np.zeros(0, np.int64)] * 3, np.zeros(0))


def score(docs: DataFrame, model: SentenceModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, score, predicted, offending: the sentences whose own
    score reaches the threshold as (start, end, score), by code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**WORD_BITS weights
    spot = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("offending", pa.list_(spot))])

    def run(batches):
        for batch in batches:
            for first, last, buf, off in chunks(batch.column(1)):
                n = last - first
                sentence, slot, doc, start, end = instances(buf, off)
                logit = shared.value.logits(sentence, slot, len(doc))
                total = -np.expm1(_noisy_or(logit, doc, n))
                p = 1 / (1 + np.exp(-logit))
                # code points: bytes that begin a character
                chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
                spots = [[] for _ in range(n)]
                for i in np.flatnonzero(p >= threshold):
                    d = doc[i]
                    spots[d].append((int(chars[start[i]] - chars[off[d]]), int(chars[end[i]] - chars[off[d]]), float(p[i])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(total), pa.array((total >= threshold).astype(np.int32)),
                     pa.array([[dict(zip(("start", "end", "score"), x, strict=True)) for x in r] for r in spots], pa.list_(spot))], schema=schema,
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double, predicted int, offending array<struct<start:long,end:long,score:double>>"
    )
