from __future__ import annotations

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import catalog, language


def test_held_out_accuracy_and_rows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = catalog.op7_language_id(spark, sf_small).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.93 * len(held)


def toy():
    text = {"en": "the thing that was with them", "de": "und nicht schön über das haus", "es": "que los niños de la mañana", "fr": "les élèves où être dans une", "xx": "qqq wvw qwq vvw"}
    return [(i, text[n] + f" {i}", n) for i, n in enumerate(sorted(text) * 12)]


def test_families_then_languages(spark):
    docs = spark.createDataFrame(toy(), "doc_id long, text string, lang string")
    model = language.fit(docs, per_language=10)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    assert set(model.machines) == {("germanic", "romance"), ("germanic", "xx"), ("romance", "xx"), ("de", "en"), ("es", "fr")}
    got = language.identify(docs, model, ("doc_id", "lang")).collect()
    assert all(r.lang_pred == r.lang for r in got)


def plain_prediction(model, text):
    """Trigram shares, margins and votes, one text at a time."""
    if text is None or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    low = "".join(c.lower() if c < "\u0100" else c for c in text).encode()
    share = {}
    for i in range(len(low) - 2):
        slot = (int.from_bytes(low[i : i + 3], "big") * 2654435761 % 2**32) >> (32 - language.FEATURE_BITS)
        share[slot] = share.get(slot, 0) + 1 / (len(low) - 2)

    def vote(names):
        if len(names) == 1:
            return names[0], 30.0
        beats = {n: [] for n in names}
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                w = model.machines[a, b]
                m = sum(v * model.scale * float(w[k]) for k, v in share.items()) + float(w[-1])
                beats[a].append(m)
                beats[b].append(-m)
        best = sorted(names, key=lambda n: (-sum(m > 0 for m in beats[n]), -sum(beats[n]), n))[0]
        return best, min(beats[best])

    family, sure = vote(sorted(model.families))
    lang, within = vote(model.families[family])
    return lang, 1 / (1 + math.exp(-2 * min(sure, within, 30.0)))


def test_predictions_equal_plain_votes(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, "12 !"), (-3, "ab"), (-4, "ÀÉ los NIÑOS"), (-5, "é")], "doc_id long, text string")
    for model in (catalog.language_model(docs), language.fit(spark.createDataFrame(toy(), "doc_id long, text string, lang string"))):
        rows = docs.select("doc_id", "text").unionByName(odd)
        text = {r.doc_id: r.text for r in rows.collect()}
        for r in language.identify(rows, model).collect():
            lang, score = plain_prediction(model, text[r.doc_id])
            assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-5)


def test_edge_cases(spark, docs_of):
    docs = spark.createDataFrame([*toy(), (900, "the thing", None), (901, None, "en")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    rows = [(1, None), (2, ""), (3, "12 !? 34"), (4, "the"), (5, "the thing that " * 20_000), (5, "the thing that"), (None, "los niños"), (6, "я")]
    got = [(r.doc_id, r.lang_pred) for r in language.identify(docs_of(rows), model).collect()]
    assert got[:3] == [(1, "und"), (2, "und"), (3, "und")]
    assert got[4:7] == [(5, "en"), (5, "en"), (None, "es")] and got[7][1] != "und"
    empty = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs_of(rows), empty).collect()} == {"und"}
    one = language.fit(docs.filter("lang = 'en'"))
    assert {r.lang_pred for r in language.identify(docs_of(rows[3:]), one).collect()} == {"en"}
    assert language.identify(docs_of([]), model).count() == 0


def test_held_out_never_teaches(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = catalog.language_model(docs), catalog.language_model(wrong)
    assert a.families == b.families and all((a.machines[k] == b.machines[k]).all() for k in a.machines)
