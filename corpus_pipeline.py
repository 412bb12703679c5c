"""A corpus pipeline of five training-data operators over ``documents``.

Each stage takes the documents that its predecessor kept, written as Parquet and
read again, and returns a DataFrame; all but the last return the columns of
``documents`` and no others. Every row is a document of its own, also where rows share an id
or have none: the stages that drop documents tell rows apart by their place in the Parquet
files (of which a 64-bit hash stands for the row).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import catalog, language, pii, tiling
from ledgerloom.llm.ngram_join import similar_documents
from ledgerloom.llm.shared import saved, table


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a number of each row by its file and place there, the same in every job."""
    try:
        place = docs.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_row"))
        place.schema  # fails where the rows come from no files  # noqa: B018
        return place
    except AnalysisException:
        return numbered(saved(docs))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language; the rest (no letters, no text) goes."""
    found = language.identify(docs, catalog.language_model(docs), COLUMNS)
    return found.filter(F.col("lang_pred") != language.UNDETERMINED).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the smallest id (none last), then the smallest digest of the text."""
    rows = numbered(docs)
    groups = similar_documents(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = saved(groups.select(F.col("doc_id").alias("_row"), "component_id"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "_row")
    first = groups.join(rows.select("_row", order.alias("order")), "_row").groupBy("component_id").agg(F.min("order").alias("order"))
    drop = groups.join(first.select(F.col("order._row").alias("_row")), "_row", "left_anti").select("_row")
    return rows.join(drop, "_row", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    rows = numbered(docs)
    found = tiling.contaminated(rows.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(found.select(F.col("doc_id").alias("_row")).distinct(), "_row", "left_anti").select(*COLUMNS)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and what gives it away replaced in the text."""
    clean = pii.sanitise(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: which documents are taken, and how often."""
    return catalog.mixture(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", sanitise),
    ("mixing", mixing),
]

#: SQL cannot express the learned and the string stages; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs)
    return docs
