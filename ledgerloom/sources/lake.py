"""Lake tables: Parquet directories written once per layer and read back, so
downstream plans start from a short lineage and get pushdown / pruning.

Scratch space comes from the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster). Only when nothing is configured, as in local tests, a
private temporary folder is set for the session. Scratch belongs to the
application that made it: ``clear_scratch`` removes all of it, which also happens
when the process ends in good order.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_owned: set[str] = set()

#: Compression of the tables: a third to a half smaller than Spark's default.
CODEC = "zstd"
#: Spark's setting that removes the shuffle files of an execution when it ends.
_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """What is executed inside removes its shuffle files as it ends. A job of several steps then holds those of
    one step at a time; otherwise they stay until the driver's garbage collection comes upon them. For
    steps whose result is written or collected at once: nobody reads their shuffles again."""
    before = spark.conf.get(_REMOVAL, "false")
    spark.conf.set(_REMOVAL, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVAL, before)


def _checkpoint_dir(spark: SparkSession) -> str:
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: no context to ask
        sc = None
    local = sc is not None and sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    configured = spark.conf.get("spark.checkpoint.dir", None) or (sc and sc.getCheckpointDir())
    if configured:
        return configured.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: scratch tables must survive executor loss")
    # unset in a local session (tests): a private folder on this machine is fine
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{_checkpoint_dir(spark)}/ledgerloom/{spark.conf.get('spark.app.id', 'app')}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the session's checkpoint directory."""
    root = _scratch_root(spark)
    if root not in _owned:
        _owned.add(root)
        atexit.register(_clear_at_exit, spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes every scratch table of this application; frames that read them end with it."""
    remove(spark, _scratch_root(spark))


def _clear_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        clear_scratch(spark)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    stored: bool = False,
) -> None:
    """Overwrite a Parquet table. With partition columns the rows are first
    rebalanced on them (``REBALANCE`` hint): AQE then cuts each partition value
    into files of the advisory size and splits a hot value, instead of every
    task writing one small file per value. ``stored``: the rows are scanned from a table that was
    written by the same columns, so each of its files gives one file for each task that reads it, and none is moved.
    Shuffle files of the write end with it."""
    if partition_by and not stored:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)


def write_pieces(pieces: Sequence[DataFrame], path: str, partition_by: Sequence[str] | None = None) -> None:
    """The rows of several frames as one new table, written one frame after another: the shuffle files of one of them are
    there at a time. Unlike one write it may die between two of them; readers must learn of the table afterwards."""
    for i, df in enumerate(pieces):
        write_table(df, path, partition_by, mode="append" if i else "overwrite")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Readable CSV directory with header (values written verbatim). Use
    ``single_file`` only for a result bounded by construction (a top-n, one row
    per scenario): it funnels the rows through one task."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
