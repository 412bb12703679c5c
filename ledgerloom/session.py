"""Local session for tests, benchmarks and examples (a cluster brings its own).

Local mode runs small inputs on a few cores: AQE's minimum coalesced partition
size is lowered so a shuffle of a few MB still spreads over all cores (the
default 1 MB floor leaves one or two tasks for CPU-heavy stages). On a
cluster the defaults (or larger advisory sizes) are the right choice."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
