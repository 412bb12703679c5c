"""Readers for the raw sources.

* Schemas are always declared, never inferred: a changed source fails at the
  boundary instead of in the middle of a business rule.
* CSV is read FAILFAST. Spark parses only the columns a plan needs, so a bare
  ``count()`` does not prove the file is well formed; ``assert_required`` runs
  one aggregation that touches every column and also enforces NOT NULL, which
  file sources do not do for ``nullable=False`` fields.
* Multiline JSON documents are read FAILFAST as well (PERMISSIVE turns a
  truncated document into one all-NULL row that explodes to nothing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .lake import scratch_path


#: Columns that ``stamp_lineage`` adds.
LINEAGE = ("_source", "_ingested_at")


def read_csv_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


#: Columns of rejected rows.
REJECTED = ("file", "reason", "raw")


def read_sorting_out(
    spark: SparkSession,
    path: str,
    schema: str,
    required: Sequence[str] = (),
    fmt: str = "csv",
    max_pct: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of CSV files with header or JSON Lines, from one parse.

    A row that does not fit the declared schema, or has no value in a required column, is rejected with its
    file, the reason and its text (as it was read, or written again where only a value is missing). The
    parsed rows are written once to scratch, good and rejected ones apart. ``max_pct``: more rejected
    rows in a hundred than that raise ``ValueError``."""
    if fmt not in ("csv", "json"):
        raise ValueError("fmt must be 'csv' or 'json'")
    columns = spark.createDataFrame([], schema).columns
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw").schema(f"{schema}, _raw string")
    parsed = reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path)
    reason = F.when(F.col("_raw").isNotNull(), "malformed")
    for c in required:
        reason = reason.when(F.col(c).isNull(), f"no {c}")
    again = F.to_csv(F.struct(*columns)) if fmt == "csv" else F.to_json(F.struct(*columns))
    rows = parsed.select(
        *columns, F.col("_metadata.file_path").alias("_file"), F.coalesce("_raw", again).alias("_text"), reason.alias("_reason"),
    ).withColumn("_good", F.col("_reason").isNull())
    rows = rows.withColumn("_text", F.when(~F.col("_good"), F.col("_text")))
    folder, seen = scratch_path(spark, "sorted-out"), Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("rejected"))
    counted.write.partitionBy("_good").parquet(folder)
    counts = seen.get
    if max_pct is not None and counts["rejected"] * 100 > max_pct * counts["rows"]:
        raise ValueError(f"{path}: {counts['rejected']} of {counts['rows']} rows rejected, over {max_pct} %")
    back = spark.read.schema(rows.schema).parquet(folder)
    good = back.where("_good").select(*columns)
    bad = back.where("not _good").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_text").alias("raw"))
    return good, bad


def read_parquet_projected(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet scan that keeps only the allowed columns (the rest, e.g. personal
    data, never leaves the scan: the projection reaches the reader's ReadSchema)."""
    return spark.read.parquet(path).select(*columns)


def read_nested_json(
    spark: SparkSession, path: str, schema: StructType | str, multiline: bool = True
) -> DataFrame:
    """One document per file (``multiline``) or JSON Lines. At scale prefer many
    documents / JSON Lines: a multiline file is a single task."""
    return (
        spark.read.option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .schema(schema)
        .json(path)
    )


def explode_array(doc: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten ``array<struct>`` at ``path`` into one row per element, its
    fields as columns; ``keep`` columns of the parent are carried along."""
    return doc.select(*keep, F.explode(path).alias("_e")).select(*keep, "_e.*")


def stamp_lineage(df: DataFrame, source: str, with_time: bool = True) -> DataFrame:
    out = df.withColumn("_source", F.lit(source))
    return out.withColumn("_ingested_at", F.current_timestamp()) if with_time else out


def assert_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Fail when a source yields no rows (an empty or fully filtered document
    set explodes to nothing without any error). Reads at most one row."""
    if not df.take(1):
        raise ValueError(f"{what}: no rows")
    return df


def assert_required(df: DataFrame, required: Sequence[str]) -> dict[str, int]:
    """One pass over all columns: forces a full parse (FAILFAST fires on any bad
    row) and counts NULLs in required columns. Raises ``ValueError`` on NULLs."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in required]
    # touching every column makes the CSV reader parse whole rows
    aggs += [F.max(F.hash(*[F.col(c) for c in df.columns])).alias("_all")]
    row = df.agg(*aggs).first()
    nulls = {c: int(row[c] or 0) for c in required}
    bad = {c: n for c, n in nulls.items() if n}
    if bad:
        raise ValueError(f"required columns with NULLs: {bad}")
    return {"rows": int(row["_rows"]), **nulls}
