"""Answers from the footers of Parquet files.

Least and largest values, null counts and row counts of a table stand in its files' footers.
Spark's columnar Parquet source answers ``min``, ``max`` and ``count`` from them when asked
to; that setting belongs to a session of its own here, so the caller's stays as it is. Columns
whose footers keep no exact bounds (texts, timestamps, decimals) and files without
statistics are read instead, with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Any, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Bounds(NamedTuple):
    """Of one column: least and largest value (None: no values) and the number of nulls."""

    least: Any
    largest: Any
    nulls: int


def footer_frame(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``rows``, and for the i-th column ``least_i``, ``largest_i``, ``values_i``."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return _bounds_frame(session, path, columns)


def _bounds_frame(session: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    found = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        found += [F.min(c).alias(f"least_{i}"), F.max(c).alias(f"largest_{i}"), F.count(c).alias(f"values_{i}")]
    return session.read.parquet(path).agg(*found)


def footer_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[int, dict[str, Bounds]]:
    """Number of rows, and the bounds of each column."""
    try:
        row = footer_frame(spark, path, columns).first()
    except Py4JJavaError as e:
        if "No min/max found" not in str(e):  # a file without statistics, or a block of nulls only
            raise
        row = _bounds_frame(spark, path, columns).first()
    rows = row["rows"] or 0  # Spark adds up the footers' counts, which of no block at all is null
    return rows, {
        c: Bounds(row[f"least_{i}"], row[f"largest_{i}"], rows - (row[f"values_{i}"] or 0)) for i, c in enumerate(columns)
    }


def footer_cutoff(spark: SparkSession, sources: Sequence[tuple[str, str]]) -> date:
    """The latest day over (path, date column) of all sources, as ``resolve_cutoff`` finds it by reading them."""
    days = [footer_bounds(spark, path, [column])[1][column].largest for path, column in sources]
    days = [d for d in days if d is not None]
    if not days:
        raise ValueError("no dated rows in any source: cannot resolve a cutoff")
    return max(days)
