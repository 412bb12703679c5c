"""Bucketed tables: rows are dealt by the hash of their key when they are written, so that later
joins and groupings on the key move none of them.

A key that holds a third of all rows would be one bucket. So a row's bucket depends on its key
and on ``bucket_salt``, a number below ``salt`` made of a hash of the whole row (so a task that runs
again deals alike); a join meets one copy of the other side for each number, and repeated
rows share a number. Rows without key are dealt by their number too. The number belongs to the
key of a join even where ``salt`` is 1: a side that is already dealt by the key alone, into
more partitions than there are buckets, would otherwise draw the stored rows to it.

A path holds the rows (``data``) and, written last, a table without rows (``schema``) whose first key column
carries key, buckets and salt as metadata: the path alone says how to read it in any session, and
what a write left that died is not readable. The catalogue holds an external table of it under
a name made of the path; dropping that leaves the files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lake import CODEC, shuffles_removed

SALT = "bucket_salt"
_NOTE = "ledgerloom.buckets"


class Bucketed(NamedTuple):
    """A bucketed table, with a column ``bucket_salt`` of numbers below ``salt``."""

    table: DataFrame
    key: tuple[str, ...]
    buckets: int
    salt: int


def _name(path: str) -> str:
    return f"ledgerloom_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def _ticked(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def write_bucketed(
    df: DataFrame | Sequence[DataFrame], path: str, key: Sequence[str], buckets: int | None = None, salt: int = 1
) -> Bucketed:
    """``df`` as a new table at ``path``, one sorted file for each bucket (as many as shuffle partitions
    where ``buckets`` is not given). A table that stands there is an error. Several frames of the same columns
    make one table, with a file for each of them in a bucket: they are written one after another, and the
    shuffle files of one are gone before the next one starts."""
    pieces = [df] if isinstance(df, DataFrame) else list(df)
    df = pieces[0]
    for piece in pieces[1:]:
        df = df.unionByName(piece)  # for its schema, and to see that the columns are the same
    if not key or salt < 1:
        raise ValueError("a key is needed, and a salt of 1 at least")
    if SALT in {c.lower() for c in df.columns}:
        raise ValueError(f"{SALT} is the name of the salt")
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt, names = [*key, SALT], [f"`{c}`" for c in df.columns]
    number = F.pmod(F.xxhash64(*map(F.col, names)), F.lit(salt)).cast("int")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    with shuffles_removed(spark):
        for i, piece in enumerate(pieces):
            (
                piece.select(*names).withColumn(SALT, number).repartition(buckets, *dealt)
                .write.mode("append" if i else "error").format("parquet").option("compression", CODEC)
                .bucketBy(buckets, *dealt).sortBy(*dealt).option("path", f"{path}/data")
                .saveAsTable(_name(path))
            )
    note = {"key": list(key), "buckets": buckets, "salt": salt}
    schema = df.withColumn(SALT, number).schema
    spark.createDataFrame([], schema).withMetadata(key[0], {_NOTE: note}).write.parquet(f"{path}/schema")
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> Bucketed:
    """The table that ``write_bucketed`` left at ``path``."""
    schema = spark.read.parquet(f"{path}/schema").schema
    note = next((f.metadata[_NOTE] for f in schema if _NOTE in f.metadata), None)
    if note is None:
        raise ValueError(f"{path}/schema names no buckets")
    dealt = _ticked([*note["key"], SALT])
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    spark.sql(
        f"CREATE TABLE {_name(path)} ({schema.toDDL()}) USING parquet "
        f"CLUSTERED BY ({dealt}) SORTED BY ({dealt}) INTO {note['buckets']} BUCKETS LOCATION '{path}/data'"
    )
    return Bucketed(spark.table(_name(path)), tuple(note["key"]), note["buckets"], note["salt"])
