"""The ``opN_*`` queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import dialogue, language, licences, mixing, multi_index, periodic, pieces, pii, repeats, rollups, tiling, toxicity
from ledgerloom.llm.ngram_join import similar_documents
from ledgerloom.llm.shared import saved, table
from ledgerloom.sources.lake import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: The public model whose pieces op11 uses, by its name in the package of public tokenizers.
PIECE_MODEL = "piece_bpe_32k.model"

#: Target weights of the mixture: by domain, language and source; what is not named weighs 1.
WEIGHTS = (
    ("domain", "d0", 4), ("domain", "d1", 3), ("domain", "d2", 2), ("domain", "d3", 1),
    ("lang", "en", 5), ("lang", "de", 2), ("lang", "fr", 2), ("lang", "es", 1),
    ("source", "src0", 3), ("source", "src1", 2),
)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.known_licences(spark))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long")
    kinds = F.array(*(F.lit(k) for k in pii.KINDS))
    written = F.transform("spans", lambda x: F.concat_ws(":", F.element_at(kinds, x.kind + 1), x.start, x.end))
    terms = F.transform("terms", lambda x: F.concat_ws(":", F.lit(pii.TERM), x.start, x.end))
    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)),
        F.sha2(F.array_join(written, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(written, terms), ",").alias("spans"),
        F.size("terms").cast("long").alias("n_terms"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~language.held_out(F.col("doc_id"))).select("doc_id", "toxic"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
        F.size("offending").cast("long").alias("n_offending"),
        F.array_join(F.transform("offending", lambda x: F.concat_ws(":", x.start, x.end)), ",").alias("offending"),
    )


def mixture(docs: DataFrame) -> DataFrame:
    """Half of all tokens by ``WEIGHTS``; a source's number modulo 4 is its domain."""
    number = F.regexp_extract(F.col("source").cast("string"), "([0-9]{1,9})$", 1)
    domain = F.when(number != "", F.concat(F.lit("d"), F.pmod(number.try_cast("int"), F.lit(4)).cast("string")))
    rows = F.array(*(F.struct(F.lit(x).alias("level"), F.lit(n).alias("name"), F.lit(w).alias("weight")) for x, n, w in WEIGHTS))
    weights = docs.sparkSession.range(1).select(F.explode(rows).alias("w")).select("w.*")
    return mixing.mix(docs.select("doc_id", "text", "lang", "source", domain.alias("domain")), weights, F.expr("all_tokens div 2"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.fit(docs.filter(~language.held_out(F.col("doc_id"))))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language_model(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches: all documents under the first tokenizer version; the copies of a text but the
    smallest id are deleted; the rest is counted again under the second version and deleted
    under the first where that is shorter than 100 tokens; the third is committed twice."""
    docs = table(spark, sf_dir, "documents")
    ledger = rollups.TokenLedger(spark, scratch_path(spark, "tokens"))
    # texts are read once: every batch is made of their digests and counts
    counted = saved(docs.select(
        "doc_id", "source", "lang", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("key"),
        rollups.word_tokens(F.col("text")).alias("words"), rollups.piece_tokens(F.col("text")).alias("pieces"),
    ))
    ledger.commit(1, rollups.changes_of(counted, "words-1", F.col("words")))
    first = counted.groupBy("key").agg(F.min("doc_id").alias("first"))
    copies = saved(counted.select("doc_id", "key").join(first, "key").filter("doc_id <> first").select("doc_id").distinct())
    ledger.commit(2, rollups.deletes_of(copies, "words-1"))
    short = ledger.state().filter("n_tokens < 100").select("doc_id")
    recounted = rollups.changes_of(counted, "pieces-2", F.col("pieces")).join(copies, "doc_id", "left_anti")
    third = recounted.unionByName(rollups.deletes_of(short, "words-1"))
    ledger.commit(3, third)
    ledger.commit(3, third)
    return ledger.totals()


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    return pieces.digests(table(spark, sf_dir, "documents"), model)


def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return dialogue.repair_report(conversations, dialogue.damage(conversations))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_license_scan, op2_pii, op3_suffix_dedup, op4_ngram_join, op5_toxicity, op6_mixing, op7_language_id,
        op8_multi_index, op9_decontamination, op10_token_counts, op11_piece_codec,
        op12_dialogue_repair, op13_periodic_runs,
    )
    return {f.__name__: f for f in found}
