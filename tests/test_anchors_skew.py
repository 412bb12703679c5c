"""Cutoff resolution and behaviour under a hot key."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.anchors import cutoff_frame, resolve_cutoff
from ledgerloom.operators.common import keep_first
from ledgerloom.operators.dimensions import close_intervals
from ledgerloom.operators.facts import cost_sales


def test_cutoff_ignores_an_empty_channel(spark):
    """D23: an empty source contributes nothing instead of failing max(None, d)."""
    a = spark.createDataFrame([(date(2026, 3, 1),), (date(2026, 3, 31),)], "d date")
    empty = spark.createDataFrame([], "d date")
    assert resolve_cutoff([(a, "d"), (empty, "d")]) == date(2026, 3, 31)
    assert cutoff_frame([(empty, "d"), (a, "d")]).first()["cutoff"] == date(2026, 3, 31)


def test_cutoff_override_and_no_data(spark):
    empty = spark.createDataFrame([], "d date")
    assert resolve_cutoff([(empty, "d")], override=date(2026, 1, 1)) == date(2026, 1, 1)
    with pytest.raises(ValueError):
        resolve_cutoff([(empty, "d")])


def test_cutoff_uses_both_channels(spark):
    pos = spark.createDataFrame([("2026-03-30 10:00:00",)], "ts string").select(F.to_timestamp("ts").alias("ts"))
    web = spark.createDataFrame([(date(2026, 3, 31),)], "ts date")
    assert resolve_cutoff([(pos, "ts"), (web, "ts")]) == date(2026, 3, 31)


def test_dedup_with_a_hot_key_is_exact(spark):
    """A third of all rows share one document id: one survivor, the smallest."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("doc_id"),
        (F.lit(n) - F.col("id")).alias("ts"),
    ).repartition(8)
    out = keep_first(df, ["doc_id"], ["ts"])
    assert out.count() == n - n // 3 + 1
    assert out.where("doc_id = 'HOT'").first()["ts"] == n - (n - 1) // 3 * 3


def test_salted_asof_with_a_hot_product(spark):
    costs = close_intervals(
        spark.createDataFrame(
            [(1, date(2025, 1, 1), 5.0), (1, date(2025, 6, 1), 7.0), (2, date(2025, 1, 1), 3.0)],
            "product_key bigint, valid_from date, cost double",
        )
    )
    facts = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("product_key"),
        F.date_add(F.lit(date(2025, 1, 1)), (F.col("id") % 300).cast("int")).alias("date"),
        F.lit(1).alias("units"),
        F.lit(10.0).alias("amount"),
        F.col("id"),
    )
    plain = cost_sales(facts, costs).select("id", "cost")
    for variant in (cost_sales(facts, costs, salt=8), cost_sales(facts, costs, strategy="window", salt=8)):
        got = variant.select("id", "cost")
        assert got.count() == 9_000
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_window_asof_pairs_no_fact_with_a_version(spark):
    """The window strategy never joins facts to versions: facts meet only the
    carry-in / in-month versions inside one sort group (key x month x salt)."""
    costs = close_intervals(
        spark.createDataFrame([(1, date(2025, 1, 1), 5.0)], "product_key bigint, valid_from date, cost double")
    )
    facts = spark.createDataFrame([(1, date(2025, 2, 1), 1, 1.0)], "product_key bigint, date date, units int, amount double")
    plan = cost_sales(facts, costs, strategy="window", salt=4)._jdf.queryExecution().executedPlan().toString()
    assert all("LeftSemi" in x for x in plan.splitlines() if "Join" in x)  # months with facts, no pairs
    assert "Window [last(_p" in plan


def test_aqe_splits_a_hot_product_in_the_range_asof_join(spark):
    """A third of the facts on one product: with broadcast off (as for a large
    cost history) the sort-merge as-of join is marked skew=true by AQE, i.e.
    the hot product's facts are split over several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        costs = close_intervals(
            spark.range(500).select(
                F.col("id").alias("product_key"), F.lit(date(2025, 1, 1)).alias("valid_from"), F.lit(5.0).alias("cost")
            )
        )
        facts = spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("product_key"),
            F.lit(date(2025, 6, 1)).alias("date"), F.lit(1).alias("units"), F.lit(10.0).alias("amount"),
        )
        out = cost_sales(facts, costs)
        assert len(out.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_the_caller_names_the_strategy(spark):
    costs = close_intervals(spark.createDataFrame([(1, date(2025, 1, 1), 5.0)], "product_key bigint, valid_from date, cost double"))
    facts = spark.createDataFrame([(1, date(2025, 1, 4), 1, 1.0)], "product_key bigint, date date, units int, amount double")
    with pytest.raises(ValueError):
        cost_sales(facts, costs, strategy="auto")


@pytest.mark.parametrize("salt", [1, 8])
def test_the_range_asof_join_never_broadcasts_a_history(spark, tmp_path, salt):
    """The planner sees the size of the catalogue's file, not of the versions and salts exploded from
    it: it would send any history through the driver."""
    versions = F.transform(F.sequence(F.lit(0), F.lit(199)), lambda i: F.struct(F.date_add(F.lit(date(2025, 1, 1)), i).alias("valid_from"), i.cast("double").alias("cost")))
    spark.range(300).select(F.col("id").alias("product_key"), versions.alias("v")).write.parquet(str(tmp_path / "catalogue"))
    catalogue = spark.read.parquet(str(tmp_path / "catalogue"))
    costs = close_intervals(catalogue.select("product_key", F.explode("v").alias("v")).select("product_key", "v.*"))
    facts = spark.range(2_000).select(
        (F.col("id") % 400).alias("product_key"), F.date_add(F.lit(date(2025, 1, 1)), (F.col("id") % 300).cast("int")).alias("date"),
        F.lit(1).alias("units"), F.lit(10.0).alias("amount"),
    )
    out = cost_sales(facts, costs, salt=salt)
    found = {r["cost"]: r["n"] for r in out.groupBy("cost").agg(F.count("*").alias("n")).collect()}
    assert sum(found.values()) == 2_000 and found[None] == 500 and found[7.0] > 0
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_window_asof_evaluates_the_facts_once(spark):
    costs = spark.createDataFrame([(1, date(2025, 1, 1), 5.0)], "product_key bigint, valid_from date, cost double")
    facts = spark.range(50).select(
        (F.col("id") % 3).alias("product_key"), F.date_add(F.lit(date(2024, 12, 1)), F.col("id").cast("int")).alias("date"),
        F.lit(1).alias("units"), F.lit(10.0).alias("amount"),
    )
    costed = cost_sales(facts, close_intervals(costs), strategy="window", salt=4)
    plan = costed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 50") == 1 and "Join" not in plan
    assert costed.where("cost = 5.0").count() == facts.where("product_key = 1 and date >= date'2025-01-01'").count()
