"""Delta-maintained token totals by source, language and tokenizer version.

A batch of changes holds, for some documents and tokenizer versions, the new state:
a count with its source and language (an insert or a revision), or null (a delete).
Against the state committed so far it becomes signed rows, the old one with -1 and
the new one with +1; unchanged documents give none. Totals are additive, so they are
the sum over the signed rows of all batches, and each batch stores its own sums.

A batch is committed under its number, as one partition of the ledger that replaces
whatever that number had: committing a batch again, after a failure or by mistake,
leaves totals as they are. A batch sees only batches with smaller numbers.

Null source or language are groups of their own. Rows without id or version are no
documents and are left out. Of several states of one document in a batch the largest
(count, then source, language; null last, so a delete loses) holds. An empty batch is
committed without rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.lake import remove


KEY = ("doc_id", "version")
STATE = ("source", "lang", "n_tokens")
LEDGER = "doc_id long, version string, source string, lang string, n_tokens long, sign int, batch long"
TOTALS = "version string, source string, lang string, n_docs long, n_tokens long, batch long"


def word_tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def piece_tokens(text: Column) -> Column:
    """Runs of letters, single digits and single other signs; a white-space character is none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\p{L}+|[^\p{L}\x20\x09-\x0D]")), F.lit(0)).cast("long")


def bpe_tokens(ranks_path: str, pattern: str) -> Column:
    """A counter of byte-pair tokens from a vocabulary file in tiktoken's format, which every
    executor must be able to open; use it as ``bpe_tokens(...)("text")``. Null counts 0."""

    @F.pandas_udf("long")
    def count(texts):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return texts.map(lambda t: 0 if t is None else len(encoding.encode_ordinary(t)))

    return count


class TokenLedger:
    """Signed rows and totals of all committed batches, below one shared path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.rows_path, self.totals_path = spark, f"{path}/rows", f"{path}/totals"

    def _read(self, path: str, schema: str) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def signed(self, before: int | None = None) -> DataFrame:
        rows = self._read(self.rows_path, LEDGER)
        return rows if before is None else rows.filter(F.col("batch") < before)

    def state(self, before: int | None = None) -> DataFrame:
        """Documents as they stand: signed rows that are not cancelled."""
        rows = self.signed(before).groupBy(*KEY, *STATE).agg(F.sum("sign").alias("sign"))
        return rows.filter("sign > 0").select(*KEY, *STATE)

    def delta(self, batch: int, changes: DataFrame) -> DataFrame:
        """Signed rows of ``changes(doc_id, version, source, lang, n_tokens)``; n_tokens null deletes."""
        changes = changes.select(
            F.col("doc_id").cast("long"), F.col("version").cast("string"), F.col("source").cast("string"),
            F.col("lang").cast("string"), F.col("n_tokens").cast("long"),
        ).filter("doc_id is not null and version is not null")
        new = changes.groupBy(*KEY).agg(F.max(F.struct("n_tokens", "source", "lang")).alias("new"))
        old = self.state(batch).select(*KEY, F.struct("n_tokens", "source", "lang").alias("old"))
        met = new.join(old, list(KEY), "left").filter(~F.col("new").eqNullSafe(F.col("old")))
        signs = F.array(
            F.struct(F.col("old").alias("s"), F.lit(-1).alias("sign")), F.struct(F.col("new").alias("s"), F.lit(1).alias("sign"))
        )
        rows = met.select(*KEY, F.explode(signs).alias("x")).filter("x.s.n_tokens is not null")
        return rows.select(*KEY, "x.s.source", "x.s.lang", "x.s.n_tokens", "x.sign")

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Commits a batch, or replaces it by the same number; later batches must not exist yet
        unless the batch is repeated unchanged."""
        delta = self.delta(batch, changes).withColumn("batch", F.lit(batch).cast("long"))
        if not self._replace(delta, self.rows_path):
            # no rows name the partition, so it is not overwritten: what the number had goes now
            for path in (self.totals_path, self.rows_path):
                remove(self.spark, f"{path}/batch={batch}")
            return
        rows = self.signed().filter(F.col("batch") == batch)
        totals = rows.groupBy("version", "source", "lang").agg(
            F.sum(F.col("sign").cast("long")).alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens")
        )
        self._replace(totals.withColumn("batch", F.lit(batch).cast("long")), self.totals_path)

    @staticmethod
    def _replace(rows: DataFrame, path: str) -> bool:
        """Each partition found in the rows is replaced when the whole write has succeeded; whether there were any."""
        seen = Observation()
        rows.observe(seen, F.count("*").alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        return seen.get["n"] > 0

    def totals(self) -> DataFrame:
        """(version, source, lang, n_docs, n_tokens): sums of the batches' sums."""
        rows = self._read(self.totals_path, TOTALS)
        out = rows.groupBy("version", "source", "lang").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return out.filter("n_docs <> 0 or n_tokens <> 0")


def changes_of(docs: DataFrame, version: str, count: Column) -> DataFrame:
    """States of ``docs(doc_id, text, source, lang)`` under a tokenizer version."""
    return docs.select("doc_id", F.lit(version).alias("version"), "source", "lang", count.alias("n_tokens"))


def deletes_of(docs: DataFrame, version: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return docs.select("doc_id", F.lit(version).alias("version"), none.alias("source"), none.alias("lang"), F.lit(None).cast("long").alias("n_tokens"))


