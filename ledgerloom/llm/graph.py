"""Connected components by alternating large and small stars (Kiveris et al., 2014).

Every round is two shuffles over the remaining links; a node that a third of all
links touch is one group of a ``min`` (pre-aggregated before the shuffle) and the
left side of a join that adaptive execution splits. Rounds are cut by checkpoints
in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import observed, saved


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select("a", "b")
    if large:
        both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    out = joined.filter("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of long ids -> ``(node, component)``, the smallest id reachable.

    Nodes without links to others are left out; null ends, self links and repeated
    links change nothing; no links give no rows. It has settled when a round leaves the same
    links; their count and hash are observed while they are written (a task that is run again can only make
    them differ, which costs a round)."""
    now = saved(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        now, mark = observed(
            _star(_star(now, large=True), large=False), F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40)).alias("h")
        )
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = mark
