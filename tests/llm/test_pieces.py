"""Piece encoding and decoding against the library itself, on random and on given texts."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import catalog, pieces

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path(catalog.PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(PATH)


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    bits = ["a", "b", " ", "  ", "the", "ing", "▁", "\n", "漢", "\U0001f600", "é", "\t", "tion", "1", " " * 6, "\x00", "x" * 7, ".", "\r\n"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_encoding_and_decoding_equal_the_library(library, model):
    coder = pieces.PieceCoder(model)
    for text in [*texts(1, 1500), "", " ", "▁", "\n", "a" * 5000, " " * 3000, "ab" * 2000 + "\U0001f600" * 50]:
        ids = library.encode(text)
        assert coder.encode(text) == ids
        assert coder.written(text) == ",".join(map(str, ids))
        assert coder.decode(ids) == library.decode(ids)


def test_decoding_any_ids_equals_the_library(library, model):
    coder, rng = pieces.PieceCoder(model), random.Random(2)
    for _ in range(5000):
        ids = [rng.choice([0, 1, 2, 29871, 259, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randrange(8))]
        assert coder.decode(ids) == library.decode(ids)


def test_plain_merging_agrees(model):
    coder = pieces.PieceCoder(model)
    for text in ("▁aaaaaaaa", "▁▁▁▁▁▁▁", "▁undesirableness", "▁ththetheththe"):
        assert [model.pieces[i] for i in coder.encode_run(text)] == coder.merged(text)


def test_few_remembered_parts_change_nothing(library, model, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 3)
    coder = pieces.PieceCoder(model)
    for text in texts(3, 200):
        assert coder.written(text) == ",".join(map(str, library.encode(text)))


def test_tables(spark, docs_of, library, model):
    rows = [(1, "Hello  wörld\n漢"), (1, "Hello  wörld\n漢"), (2, None), (3, ""), (None, "no id"), (4, "word " * 30000)]
    docs = docs_of(rows)
    got = sorted(map(tuple, pieces.digests(docs, model).collect()), key=str)
    want = []
    for i, text in rows:
        ids = library.encode(text or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.append((i, len(ids), *sha))
    assert got == sorted(want, key=str)
    coded = pieces.encode(docs.withColumn("ids", F.lit("x")), model, keep=("doc_id", "rank"))
    assert coded.columns == ["doc_id", "rank", "ids"]
    back = {tuple(r) for r in pieces.decode(coded, model).collect()}
    assert back == {(i, t or "") for i, t in rows}
    assert pieces.digests(docs.limit(0), model).collect() == []
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), model).first().text == ""


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        pieces.read_model(str(tmp_path / "m"))


def test_query_on_given_documents(spark, sf_small, library):
    got = {r.doc_id: r for r in catalog.op11_piece_codec(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "")
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
