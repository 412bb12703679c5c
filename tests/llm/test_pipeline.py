from __future__ import annotations

import importlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pii

corpus_pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """Input and output of every stage on the small tables."""
    docs, out = spark.read.parquet(f"{sf_small}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        result = f(spark, docs, sf_small).cache()
        out.append((name, docs, result))
        docs = result
    return out


def test_order_and_columns(stages):
    assert [n for n, _, _ in stages] == ["language_id", "near_duplicates", "decontamination", "pii", "mixing"]
    assert all(result.dtypes == stages[0][1].dtypes for _, _, result in stages[:-1])


def test_each_stage_against_a_plain_version(spark, sf_small, stages):
    from test_ngram_join import brute
    from test_tiling import greedy, words

    rows = {n: ({r.doc_id: r for r in a.collect()}, {r.doc_id: r for r in b.collect()}) for n, a, b in stages}
    before, after = rows["language_id"]
    assert after.keys() == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}
    assert sum(after[i].lang == before[i].lang for i in after) >= 0.95 * len(after)

    before, after = rows["near_duplicates"]
    groups = brute([(i, r.text) for i, r in before.items()])
    assert after.keys() == {i for i, (_, c) in groups.items() if i == c}
    assert len(after) < len(before)

    before, after = rows["decontamination"]
    items = [words(r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    seeds = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in items]
    dirty = set()
    for i, r in before.items():
        d = words(r.text)
        own = {tuple(d[j : j + 5]) for j in range(len(d) - 4)}
        dirty |= {i for w, s in zip(items, seeds, strict=True) if own & s and 2 * sum(t[2] for t in greedy(d, w, 5)) >= len(w)}
    assert after.keys() == before.keys() - dirty

    before, after = rows["pii"]
    assert after.keys() == before.keys()
    for i, r in after.items():
        assert not [s for s in pii.base_spans(r.text) if s[0] != 2] and r.n_chars == len(r.text)
        if not pii.base_spans(before[i].text):
            assert r.text == before[i].text

    before, after = rows["mixing"]
    assert after.keys() <= before.keys() and all(r.copies > 0 for r in after.values())
    total = sum(len(r.text.split()) for r in before.values())
    assert 0.6 * (total // 2) <= sum(r.copies * r.n_tokens for r in after.values()) <= total // 2


def test_run(spark, sf_small, stages):
    got = corpus_pipeline.run(spark, sf_small)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_edge_cases(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = docs.filter("doc_id < 60").unionByName(docs.filter("doc_id < 5")).unionByName(
        docs.filter("doc_id < 3").withColumns({"doc_id": F.lit(None).cast("long"), "source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    ).unionByName(docs.filter("doc_id in (7, 8)").withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.when(F.col("doc_id") == 7, F.lit("")).cast("string")}))
    odd = odd.withColumns({n: F.lit("x") for n in ("lang_pred", "score", "component_id", "text_key", "terms", "domain")})
    for start in (odd, docs.limit(0)):
        now = start
        for i, (_, f) in enumerate(corpus_pipeline.STAGES):
            now = f(spark, now, sf_small).cache()
            assert now.count() >= 0
            if i < 4:
                assert now.columns == docs.columns


def test_rows_without_id_and_with_shared_ids(spark, sf_small):
    """Decisions reach rows by what they are, not by their id."""
    item = spark.read.parquet(f"{sf_small}/benchmark.parquet").first().text
    clean = " ".join(f"clean{i}" for i in range(40))
    texts = [(None, item), (None, clean), (7, item + " x"), (7, "Another " + clean[::-1]), (8, clean), (8, clean)]
    rows = spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.decontamination(spark, rows, sf_small)
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, (x for x in texts if item not in x[1])))
    once = [r.text for r in corpus_pipeline.near_duplicates(spark, rows, sf_small).collect()]
    assert sorted(x for x in once if item not in x) == sorted({t for _, t in texts if item not in t})
