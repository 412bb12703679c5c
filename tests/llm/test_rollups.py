from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import rollups as R

SCHEMA = "doc_id long, version string, source string, lang string, n_tokens long"


def totals(ledger):
    return {(r.version, r.source, r.lang): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}


def of(state):
    n, t = Counter(), Counter()
    for (_, version), (source, lang, count) in state.items():
        n[version, source, lang] += 1
        t[version, source, lang] += count
    return {k: (n[k], t[k]) for k in n}


def test_random_batches_equal_a_recount(spark, tmp_path):
    rnd = random.Random(9)
    ledger, state, batches = R.TokenLedger(spark, str(tmp_path)), {}, []
    for batch in range(1, 5):
        rows = {}
        for _ in range(60):
            key = (rnd.randrange(50), rnd.choice(["v1", "v2"]))
            gone = batch > 1 and rnd.random() < 0.3
            rows[key] = None if gone else (rnd.choice(["s0", None]), rnd.choice(["en", "de"]), rnd.randrange(9))
        for key, value in rows.items():
            state.pop(key, None)
            if value:
                state[key] = value
        changes = spark.createDataFrame([(*k, *(v or (None, None, None))) for k, v in rows.items()], SCHEMA)
        batches.append(changes)
        ledger.commit(batch, changes)
        assert totals(ledger) == of(state)
    ledger.commit(4, batches[3])  # again
    assert totals(ledger) == of(state)
    assert {(r.doc_id, r.version): (r.source, r.lang, r.n_tokens) for r in ledger.state().collect()} == state


def test_a_batch_that_failed_half_way_is_repaired(spark, tmp_path):
    ledger = R.TokenLedger(spark, str(tmp_path))
    ledger.commit(1, spark.createDataFrame([(1, "v", "s", "en", 5)], SCHEMA))
    second = spark.createDataFrame([(1, "v", "s", "en", 7), (2, "v", "s", "en", 1)], SCHEMA)
    whole, ledger._replace = ledger._replace, lambda rows, path: whole(rows, path) if path.endswith("rows") else (_ for _ in ()).throw(OSError())
    with pytest.raises(OSError):
        ledger.commit(2, second)
    assert totals(ledger) == {("v", "s", "en"): (1, 5)}
    ledger._replace = whole
    ledger.commit(2, second)
    assert totals(ledger) == {("v", "s", "en"): (2, 8)}


def test_edge_cases(spark, tmp_path):
    ledger = R.TokenLedger(spark, str(tmp_path))
    assert totals(ledger) == {}
    ledger.commit(1, spark.createDataFrame([], SCHEMA))
    rows = [(1, "v", None, None, 3), (1, "v", None, None, 3), (None, "v", "s", "en", 9), (2, None, "s", "en", 9), (3, "v", "s", "en", 0), (4, "v", "s", "en", 2), (4, "v", "s", "en", None), (9, "v", None, None, None)]
    ledger.commit(2, spark.createDataFrame(rows, SCHEMA).withColumn("sign", F.lit("x")).withColumn("batch", F.lit("y")))
    assert totals(ledger) == {("v", None, None): (1, 3), ("v", "s", "en"): (2, 2)}
    ledger.commit(3, spark.createDataFrame([(1, "v", None, None, 3)], SCHEMA))  # unchanged
    assert ledger.signed().filter("batch = 3").count() == 0


def test_counts(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "a  b\tc\n"), (4, "don't été 42"), (5, "x " * 50_000)]
    got = docs_of(rows).select("doc_id", R.word_tokens(F.col("text")).alias("w"), R.piece_tokens(F.col("text")).alias("p")).collect()
    assert [(r.w, r.p) for r in got] == [(0, 0), (0, 0), (3, 3), (3, 6), (50_000, 50_000)]


def test_byte_pair_counter(spark, docs_of):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    if not os.path.exists(path):
        pytest.skip("vocabulary not available")
    import base64

    with open(path, "rb") as f:
        size = max(len(base64.b64decode(x.split()[0])) for x in f)
    count = R.bpe_tokens(path, r"\p{L}+|\p{N}+|[^\p{L}\p{N}]")
    rows = [(1, None), (2, ""), (3, "the the"), (4, "Öl 12")]
    got = {r.doc_id: r.n for r in docs_of(rows).select("doc_id", count("text").alias("n")).collect()}
    assert got[1] == got[2] == 0 and got[3] == 3 and 4 <= got[4] <= 6 and size > 1


def test_a_batch_replaced_by_an_empty_one(spark, tmp_path):
    ledger = R.TokenLedger(spark, f"file://{tmp_path}/ledger")
    docs = spark.createDataFrame([(1, "a b c", "s", "en"), (2, "d", "s", "en")], "doc_id long, text string, source string, lang string")
    changes = R.changes_of(docs, "v", R.word_tokens(docs.text))
    ledger.commit(1, changes.limit(0))
    assert ledger.totals().count() == 0
    ledger.commit(1, changes)
    assert [tuple(r) for r in ledger.totals().collect()] == [("v", "s", "en", 2, 4)]
    ledger.commit(1, changes.limit(0))
    assert ledger.totals().count() == 0 and ledger.state().count() == 0
