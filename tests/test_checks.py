"""Data checks: counts, thresholds, gate."""

from __future__ import annotations

from datetime import date

import pytest

from ledgerloom.operators import checks as chk
from ledgerloom.plans import catalog
from ledgerloom.plans.model import RetailModel
from ledgerloom.sources import lake

SALES = "product_key bigint, units int, amount double"
PROD = "product_key bigint"
INV = "date date, store_id string, product_key bigint, units int, reading_valid boolean"


def _by_name(df):
    return {r["check"]: r for r in df.collect()}


def test_null_key_counts_as_orphan(spark):
    """D8: an unparseable key (NULL) is an orphan; NOT IN would skip it."""
    sales = spark.createDataFrame([(1, 1, 10.0), (None, 1, 10.0), (9, 1, 10.0)], SALES)
    prods = spark.createDataFrame([(1,)], PROD)
    r = _by_name(chk.sales_checks(sales, prods, max_pct_orphans=50.0))["sales_have_product"]
    assert (r["failed"], r["total"]) == (2, 3) and r["ok"] is False


def test_threshold_compares_counts_not_rounded_pct(spark):
    """D10: one bad row in 3,000,000 rounds to 0.0000 % but still fails a 0 % limit."""
    sales = spark.range(3_000_000).selectExpr("cast(1 as bigint) as product_key", "1 as units",
                                              "case when id = 0 then null else 1.0d end as amount")
    prods = spark.createDataFrame([(1,)], PROD)
    r = _by_name(chk.sales_checks(sales, prods))["amounts_converted"]
    assert r["failed"] == 1 and r["pct"] == 0.0 and r["ok"] is False


def test_store_check_in_the_same_pass(spark):
    sales = spark.createDataFrame([(1, "T1", 1, 10.0), (1, "T9", 1, 10.0), (1, None, 1, 10.0)],
                                  "product_key bigint, store_id string, units int, amount double")
    prods = spark.createDataFrame([(1,)], PROD)
    stores = spark.createDataFrame([("T1",)], "store_id string")
    rows = _by_name(chk.sales_checks(sales, prods, stores=stores))
    assert len(rows) == 4 and rows["sales_have_store"]["failed"] == 2
    alone = chk.check_sales_have_store(sales, stores).first()
    assert alone["failed"] == 2


def test_sign_check(spark):
    sales = spark.createDataFrame([(1, 2, 10.0), (1, -1, 5.0), (1, 0, 0.0)], SALES)
    r = _by_name(chk.sales_checks(sales, spark.createDataFrame([(1,)], PROD)))["sign_coherent"]
    assert r["failed"] == 1


def test_invalid_readings_warn_and_negative_stock_fails(spark):
    inv = spark.createDataFrame(
        [(date(2026, 1, 1), "T", 1, None, False), (date(2026, 1, 2), "T", 1, -1, True), (date(2026, 1, 3), "T", 1, 2, True)], INV
    )
    rows = _by_name(chk.inventory_checks(inv))
    assert rows["readings_valid"]["severity"] == "warning" and rows["readings_valid"]["ok"] is False
    assert rows["stock_not_negative"]["failed"] == 1


def test_grain_check_runs_before_dedup(spark):
    """D11: duplicates are visible because the check reads the pre-dedup readings."""
    readings = spark.createDataFrame(
        [(date(2026, 1, 1), "T", 1, 5, True), (date(2026, 1, 1), "T", 1, 5, True), (date(2026, 1, 2), "T", 1, 5, True)], INV
    )
    r = chk.check_grain_unique(readings).first()
    assert (r["failed"], r["total"], r["ok"]) == (1, 2, False)


def test_report_gate_and_enforce(spark):
    sales = spark.createDataFrame([(1, 1, None)], SALES)
    report = chk.quality_report([chk.sales_checks(sales, spark.createDataFrame([(1,)], PROD))], date(2026, 3, 31))
    assert report.count() == 3
    gate = chk.quality_gate(report).collect()
    assert [r["check"] for r in gate] == ["amounts_converted"]
    with pytest.raises(chk.QualityError, match="amounts_converted"):
        chk.enforce(report)


def test_detail_says_what_was_counted(spark):
    inv = spark.createDataFrame([(date(2026, 1, 1), "T", 1, None, False), (date(2026, 1, 2), "T", 1, 3, True)], INV)
    assert _by_name(chk.inventory_checks(inv))["readings_valid"]["detail"] == "1 of 2 readings are unknown"


def test_a_costed_fact_is_checked_for_costs_too(spark):
    rows = [(1, 1, 1.0, 2.0, True), (1, 1, 1.0, None, True), (1, 0, 0.0, None, False), (None, 1, 1.0, None, True)]
    costed = spark.createDataFrame(rows, SALES + ", cost double, is_revenue boolean")
    prods = spark.createDataFrame([(1,)], PROD)
    assert _by_name(chk.sales_checks(costed, prods))["cost_covered"]["failed"] == 1 == chk.check_cost_covered(costed).first()["failed"]


def test_unknown_document_types(spark):
    raw = spark.createDataFrame([("I",), ("N",), ("Z",), (None,)], "doc_type string")
    assert chk.check_document_types(raw).first()["failed"] == 2


def test_empty_table_passes_with_zero_total(spark):
    r = _by_name(chk.inventory_checks(spark.createDataFrame([], INV)))["stock_not_negative"]
    assert (r["failed"], r["total"], r["ok"], r["pct"]) == (0, 0, True, 0.0)


def test_a_key_of_most_rows_meets_its_dimension_once(spark):
    """Sales are counted by store before they meet the stores, which are not broadcast."""
    sales = spark.range(1_000).selectExpr("if(id % 2 = 0, 'ONLINE', if(id % 50 = 1, null, 'T' || id % 7)) as store_id")
    stores = spark.createDataFrame([("ONLINE",), ("T1",), ("T1",), (None,)], "store_id string")
    report = chk.check_sales_have_store(sales, stores)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert any("keys=[store_id" in x and "partial_count(1)" in x for x in plan.splitlines())
    known = sales.where("store_id in ('ONLINE', 'T1')").count()
    r = report.first()
    assert (r["failed"], r["total"]) == (1_000 - known, 1_000)
    none = chk.check_sales_have_store(sales.limit(0), stores).first()
    assert (none["failed"], none["total"], none["ok"]) == (0, 0, True)


def test_a_report_keeps_the_shuffles_of_no_step_and_costs_channels_apart(spark, sf_small, shuffles_left, monkeypatch):
    """What its tables were shuffled with is gone when they are written: only the dates' few rows are left."""
    written, write = [], lake.write_table

    def seen(df, path, *args, **kw):
        written.append((path.rsplit("/", 1)[1].rsplit("-", 1)[0], df))
        write(df, path, *args, **kw)

    monkeypatch.setattr(lake, "write_table", seen)
    report = catalog.quality_report(spark, sf_small)
    assert shuffles_left(most=10_000) <= 10_000
    assert [name for name, _ in written] == ["report-costed", "report-costed", "report-readings", "report-inventory"]
    pos, online = (df for name, df in written if name == "report-costed")
    assert pos.where("channel <> 'physical'").isEmpty() and online.where("channel <> 'online'").isEmpty()
    m = RetailModel(spark, sf_small)
    whole = m.costed.select(*pos.columns)
    both = pos.unionByName(online)
    assert whole.exceptAll(both).isEmpty() and both.exceptAll(whole).isEmpty()
    assert {r["check"]: r["total"] for r in report.collect()}["cost_covered"] == whole.count()


def test_a_gate_keeps_the_shuffles_of_no_step(spark, sf_small, shuffles_left):
    gate = catalog.quality_gate(spark, sf_small)
    assert shuffles_left(most=10_000) <= 10_000
    rows = gate.collect()
    assert rows and all(r["severity"] == chk.ERROR and not r["ok"] for r in rows)
