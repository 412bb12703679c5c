"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ledgerloom.sources.lake import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Written to the shared scratch folder and read again: executors may be lost
    later without the work above being repeated."""
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
    """``saved``, and aggregates over the rows taken while they are written."""
    seen = Observation()
    return saved(df.observe(seen, *metrics)), seen.get
