"""Small DataFrame utilities shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

# Largest side that may be hinted for broadcast, in bytes of its rows; beyond it
# the join is a sort-merge join.
BROADCAST_MAX_BYTES = 16 << 20


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the smallest row in the order of ``order`` (then the
    remaining columns), i.e. a deterministic ``dropDuplicates``. A row with a NULL in
    its key identifies nothing, so it repeats nothing: such rows all stay.

    Written as ``min(struct)`` aggregation rather than ``row_number()``: the
    partial (map-side) aggregate collapses a hot key before the shuffle, so a key
    holding a large share of the rows never lands whole in one task.
    """
    others = [c for c in df.columns if c not in keys]
    first = [c for c in (order or []) if c in others]
    packed = first + [c for c in others if c not in first]
    nullable = [c for c in keys if df.schema[c].nullable]
    if not packed and not nullable:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c) for c in packed]) if packed else F.struct(F.lit(0).alias("_none"))
    columns = [*keys, *[F.col(f"_first.{c}").alias(c) for c in packed]]
    if not nullable:
        return df.groupBy(*keys).agg(F.min(row).alias("_first")).select(*columns).select(*df.columns)
    # in the same pass a row without key is a group of its own content, as often as it was there
    unkeyed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in nullable])
    agg = df.groupBy(*keys, F.when(unkeyed, row).alias("_own")).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_n"))
    kept = F.when(unkeyed, F.array_repeat("_first", F.col("_n").cast("int"))).otherwise(F.array("_first"))
    return agg.select(*keys, F.explode(kept).alias("_first")).select(*columns).select(*df.columns)


def broadcast_if_small(df: DataFrame, rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only behind a size check: ``rows`` is a proven upper bound of the
    row count (an analytic bound, or the row count of a table ``df`` is one-to-one with,
    which Parquet answers from file footers), a row takes 16 bytes a column and 32 more a
    text. A larger side is shuffled and merged: the planner goes by the size of its compressed
    file and would send a larger one through the driver."""
    width = sum(16 + 32 * isinstance(f.dataType, StringType) for f in df.schema.fields)
    return F.broadcast(df) if rows * width <= max_bytes else df.hint("merge")


def as_timestamp(df: DataFrame, col: str) -> Column:
    """Wall-clock timestamp (TIMESTAMP_NTZ: never shifted by a session time zone)."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, StringType):
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def as_date(df: DataFrame, col: str) -> Column:
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, DateType):
        return c
    if isinstance(dtype, StringType):
        return F.try_to_date(c)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(c)
    return c.cast("date")
