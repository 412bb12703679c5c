"""Hierarchical language identification.

A linear support vector machine tells the language families apart (one machine
for each pair of families); within the chosen family one-versus-one machines for
each pair of its languages vote. Features are hashed byte trigrams of the whole
text in small letters, as shares of the text's trigrams, so a text's decision value
is one table lookup per byte and a sum.

The machines (squared hinge loss, L2 penalty, accelerated full gradient descent)
are fitted on a bounded sample: of every language at most ``per_language`` rows,
the first by the hash of their id, each with its whole text.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.texthash import U, chunks, lower_latin

#: Families of languages by ISO 639-1 code. Others are families of their own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
}
FEATURE_BITS = 12
PER_LANGUAGE = 1500
UNDETERMINED = "und"


def _slots(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every byte trigram that lies in one text, and the text of each."""
    low = lower_latin(buf)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = low[:-2].astype(np.uint32) << 16 | low[1:-1].astype(np.uint32) << 8 | low[2:]
    slot = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    inside = doc[:-2] == doc[2:]
    return slot[inside].astype(np.int64), doc[:-2][inside]


def _machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Weights and bias (last) of a linear machine for y = +1 or -1, classes weighted alike."""
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    v, t = w, 1.0
    rate = np.float32(1.0 / (2 * float(weight @ np.einsum("ij,ij->i", x, x)) + penalty))
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        step = v - rate * (np.float32(penalty) * v - 2 * ((weight * y * slack) @ x))
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v = step + np.float32((last - 1) / t) * (step - w)
        w = step
    return w


@dataclass
class LanguageModel:
    """Families with their languages; weights of the machine for each ordered pair of names."""

    families: dict[str, list[str]]
    scale: float = 1.0
    machines: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text: the score is the least of the winner's
        margins on its way, through a logistic; texts without letters get ``und``, 0."""
        names = list(self.machines)
        table = np.stack([self.machines[n][:-1] for n in names], axis=1) if names else np.zeros((1 << FEATURE_BITS, 0))
        bias = np.array([self.machines[n][-1] for n in names])
        letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_pylist()
        langs, scores = [], []
        for first, last, buf, off in chunks(column):
            slot, doc = _slots(buf, off)
            count = np.bincount(doc, minlength=last - first)
            margin = np.stack(
                [np.bincount(doc, weights=table[:, i][slot], minlength=last - first) for i in range(len(names))], axis=1
            ) if names else np.zeros((last - first, 0))
            margin = margin * (self.scale / np.maximum(count, 1))[:, None] + bias
            for row in range(last - first):
                if not letters[first + row] or not self.families:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                by = dict(zip(names, margin[row], strict=True))
                family, sure = _vote(sorted(self.families), by)
                lang, within = _vote(self.families[family], by)
                langs.append(lang)
                scores.append(1 / (1 + np.exp(-2 * min(sure, within, 30.0))))
        return langs, np.array(scores)


def _vote(names: list[str], by: dict[tuple[str, str], float]) -> tuple[str, float]:
    """The name that wins most of its pairs (ties: the larger sum of margins, then the name), and its least margin."""
    if len(names) == 1:
        return names[0], np.inf
    wins = {}
    for n in names:
        own = [by[a, b] if a == n else -by[a, b] for a, b in combinations(names, 2) if n in (a, b)]
        wins[n] = (sum(m > 0 for m in own), sum(own), min(own))
    best = min(names, key=lambda n: (-wins[n][0], -wins[n][1], n))
    return best, wins[best][2]


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, families: dict = FAMILIES) -> LanguageModel:
    """``labelled(doc_id, text, lang)`` -> model; rows without lang or text teach nothing.

    The sample is turned to features by the executors, and one task fits the
    machines on these ``per_language`` rows for each language at most."""
    rows = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    # which rows: only ids and languages are shuffled
    key = F.struct(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    # a threshold on the hash leaves some times the bound; only what is below it is ordered
    slim = rows.select("lang", "doc_id").withColumn("k", key)
    known = slim.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n"))
    below = F.shiftrightunsigned(F.col("k.col1"), 1) / F.lit(2.0**63) * F.col("n") <= 4 * per_language + 1000
    slim = slim.join(known, "lang").filter(below).select("lang", "doc_id", "k").distinct()
    slim = slim.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("k"))).filter(F.col("r") <= per_language)
    picked = rows.join(F.broadcast(slim.select("lang", "doc_id")), ["lang", "doc_id"])  # bounded by the sample
    schema = pa.schema([("lang", pa.string()), ("x", pa.binary())])

    def features(batches):
        for batch in batches:
            for first, last, buf, off in chunks(batch.column(1)):
                slot, doc = _slots(buf, off)
                size = 1 << FEATURE_BITS
                x = np.bincount(doc * size + slot, minlength=(last - first) * size).reshape(-1, size)
                x = (x / np.maximum(x.sum(axis=1, keepdims=True), 1)).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array([r.tobytes() for r in x], pa.binary())], schema=schema
                )

    def train(batches):
        frames = [b.to_pandas() for b in batches]
        if frames:
            sample = pd.concat(frames).sort_values(["lang", "x"])
            model = fit_features(sample["lang"].to_numpy(), np.stack([np.frombuffer(b, np.float32) for b in sample["x"]]), families)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    sample = picked.select("lang", "text").mapInArrow(features, "lang string, x binary")
    found = sample.repartition(1).mapInArrow(train, "model binary").collect()
    return pickle.loads(found[0].model) if found else LanguageModel({})


def fit_features(lang: np.ndarray, x: np.ndarray, families: dict = FAMILIES) -> LanguageModel:
    langs = sorted(set(lang))
    of = {n: next((f for f, known in families.items() if n in known), n) for n in langs}
    model = LanguageModel({f: [n for n in langs if of[n] == f] for f in sorted(set(of.values()))})
    model.scale = 1 / max(1e-9, float(np.median(np.linalg.norm(x, axis=1))))
    x = np.concatenate([x * np.float32(model.scale), np.ones((len(x), 1), np.float32)], axis=1)
    family = np.array([of[n] for n in lang])
    for names, label in ((sorted(model.families), family), *((own, lang) for own in model.families.values())):
        for a, b in combinations(names, 2):
            rows = (label == a) | (label == b)
            model.machines[a, b] = _machine(x[rows], np.where(label[rows] == a, 1.0, -1.0)).astype(np.float32)
    return model


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns (none named like the others), lang_pred and score for every row of ``docs(text, ...)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of languages
    names = [*keep, "lang_pred", "score"]

    def run(batches):
        for batch in batches:
            text = batch.column(len(keep))
            langs, scores = shared.value.predict(text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names
            )

    free = next(n for n in ("text", "_text", "__text") if n not in keep)
    source = docs.select(*keep, F.col("text").cast("string").alias(free))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)])
    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double")
