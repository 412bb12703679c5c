"""Layered run on the smallest benchmark tables and on raw files."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.anchors import quarter_start
from ledgerloom.operators.checks import QualityError
from ledgerloom.plans import bindings as b
from ledgerloom.plans.layers import run_layers
from ledgerloom.plans.model import RetailModel
from ledgerloom.sources import FeedPaths, lake
from ledgerloom.sources.versions import Lake


@pytest.fixture(scope="module")
def full(spark, sf_small, tmp_path_factory):
    root = tmp_path_factory.mktemp("full") / "lake"
    return root, run_layers(spark, sf_small, str(root), stop_on_error=False)


def test_full_run_writes_every_layer_and_report(spark, full):
    root, r = full
    for name in ("pos_raw", "fx_raw", "fct_sales", "fct_inventory", "negative_margin_product", "stockout_sensitivity"):
        assert name in r.tables and r.tables[name].count() >= 0
    assert len(r.report) == 12 and all(x["detail"] for x in r.report)
    saved = spark.read.json(str(root / "reports" / "quality"))
    assert {x["check"] for x in saved.collect()} == {x["check"] for x in r.report}
    # facts are partitioned by month
    published = Lake(spark, str(root)).current().entries
    assert any(p.name.startswith("month=") for p in (root / published["silver/fct_sales"]).iterdir())
    assert r.tables["stockout_sensitivity"].count() == 3
    assert {n.split("/")[0] for n in published} == {"bronze", "silver", "gold", "reports"}


def test_bronze_carries_lineage(full):
    _, r = full
    for name in RetailModel.BRONZE:
        assert [x[0] for x in r.tables[name].select("_source").distinct().collect()] == [f"tables:{name}"]
        assert r.tables[name].where(F.col("_ingested_at").isNull()).count() == 0
    assert not {"_source", "_ingested_at"} & set(r.tables["fct_sales"].columns)


def test_failed_error_check_leaves_what_was_published(spark, sf_small, full):
    """D22: the report is there, and silver and gold are those of the run before."""
    root, before = full
    files = {p: p.stat().st_mtime_ns for p in (root / "versions").rglob("*.parquet")}
    published = Lake(spark, str(root)).current()
    (root / "reports" / "quality" / "_SUCCESS").unlink()
    with pytest.raises(QualityError, match="mapping_consistent"):
        run_layers(spark, sf_small, str(root), stop_on_error=True)
    assert {p: p.stat().st_mtime_ns for p in (root / "versions").rglob("*.parquet")} == files
    assert Lake(spark, str(root)).current() == published
    assert (root / "reports" / "quality" / "_SUCCESS").is_file()
    assert before.tables["negative_margin_product"].count() >= 0


def test_a_first_failed_run_publishes_nothing(spark, sf_small, tmp_path):
    with pytest.raises(QualityError):
        run_layers(spark, sf_small, str(tmp_path / "lake"))
    assert (tmp_path / "lake" / "reports" / "quality").is_dir()
    assert Lake(spark, str(tmp_path / "lake")).current().number == 0
    assert not list((tmp_path / "lake" / "versions").rglob("*.parquet"))


def test_fixed_cutoffs_move_windows_not_rates(spark, sf_small, full, tmp_path):
    root, free = full
    fixed = run_layers(
        spark, sf_small, str(tmp_path / "b"), stop_on_error=False, cutoff=date(2001, 6, 30), stock_cutoff=free.stock_cutoff - timedelta(days=9)
    )
    assert (fixed.cutoff, fixed.stock_cutoff) == (date(2001, 6, 30), free.stock_cutoff - timedelta(days=9))
    assert fixed.tables["fx_raw"].count() == spark.read.parquet(str(root / Lake(spark, str(root)).current().entries["bronze/fx_raw"])).count()
    missing = {r["check"]: r["failed"] for r in free.report}["amounts_converted"]
    assert {r["check"]: r["failed"] for r in fixed.report}["amounts_converted"] == missing
    stock = fixed.tables["fct_inventory"].where(F.col("date").between(quarter_start(fixed.stock_cutoff), fixed.stock_cutoff))
    observed = stock.join(fixed.tables["dim_store"], "store_id").where("reading_valid").count()
    assert fixed.tables["zero_days_by_store"].agg(F.sum("observed_days")).first()[0] == observed > 0


@pytest.fixture(scope="module")
def files(spark, sf_small, tmp_path_factory):
    """The feeds as files: CSV, Parquet, and ERP documents as JSON Lines."""
    root, m = tmp_path_factory.mktemp("feeds"), RetailModel(spark, sf_small)
    lake.export_csv(m.pos_raw, str(root / "sales"))
    lake.export_csv(m.fx_raw.withColumn("date", F.col("date").cast("string")), str(root / "fx"))
    m.online_raw.withColumn("email", F.lit("private")).write.parquet(str(root / "orders"))
    docs = b.snapshot_documents(m.snapshots_raw)
    for name, rows in (("stores", m.stores_raw), ("mappings", m.mappings_raw), ("catalog", m.catalog_raw)):
        docs = docs.unionByName(b.single_documents(rows, name), allowMissingColumns=True)
    docs.write.json(str(root / "erp"))
    return FeedPaths(*(str(root / n) for n in ("sales", "fx", "orders", "erp")), erp_multiline=False)


def test_raw_files_give_the_same_marts(spark, full, files, tmp_path):
    _, tables = full
    shelf = tables.stock_cutoff  # the files do not tell shelf and dispatch counts apart
    r = run_layers(spark, lake_dir=str(tmp_path / "lake"), stop_on_error=False, stock_cutoff=shelf, feeds=files)
    assert r.cutoff == tables.cutoff
    for name in ("negative_margin_product", "negative_margin_product_store", "growth_by_channel", "turnover_top", "stockout_detail", "zero_days_by_store"):
        assert sorted(map(str, r.tables[name].collect())) == sorted(map(str, tables.tables[name].collect())), name
    assert "email" not in r.tables["online_raw"].columns
    assert all("_source" in r.tables[n].columns for n in ("pos_raw", "fx_raw", "online_raw", "stores_raw", "mappings_raw", "catalog_raw", "snapshots_raw"))


def test_files_with_missing_values_are_refused(spark, files, tmp_path):
    (tmp_path / "fx.csv").write_text("date,currency,rate\n2001-01-01,,17\n")
    with pytest.raises(ValueError, match="currency"):
        run_layers(spark, lake_dir=str(tmp_path / "lake"), feeds=FeedPaths(files.sales_csv, str(tmp_path / "fx.csv"), files.orders_parquet, files.erp_json, False))


def test_arguments(spark, sf_small):
    with pytest.raises(ValueError):
        run_layers(spark)
    with pytest.raises(ValueError):
        run_layers(spark, sf_small, until="copper")


def test_facts_are_those_of_the_costed_rows(spark, sf_small, full, tmp_path, monkeypatch):
    """A fact is read from its costed rows, where it lies by month: nothing is dealt for it again."""
    _, r = full
    m = RetailModel(spark, sf_small)
    for name, plan in (("fct_sales", m.sales), ("fct_inventory", m.inventory)):
        got, wanted = r.tables[name].drop("month"), plan
        assert got.columns == wanted.columns and got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    plans, write = {}, lake.write_table

    def seen(df, path, *args, **kw):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().executedPlan().toString(), kw.get("stored")
        write(df, path, *args, **kw)

    monkeypatch.setattr(lake, "write_table", seen)
    run_layers(spark, sf_small, str(tmp_path / "lake"), until="silver", stop_on_error=False)
    for name in ("fct_sales", "fct_inventory"):
        assert "Exchange" not in plans[name][0] and plans[name][1]
    assert "Exchange" in plans["fct_sales_costed"][0] and not plans["fct_sales_costed"][1]


def test_a_run_keeps_the_shuffles_of_no_table_and_costs_channels_apart(spark, sf_small, tmp_path, shuffles_left, monkeypatch):
    """What its tables were shuffled with is gone when they are written and so are the readings, which
    were there for two steps."""
    root = Path(lake._scratch_root(spark).removeprefix("file:"))
    readings = lambda: {p.name for p in root.glob("readings-*")}
    before, written, write = readings(), [], lake.write_table

    def seen(df, path, *args, **kw):
        written.append((path.rsplit("/", 1)[1], df))
        write(df, path, *args, **kw)

    monkeypatch.setattr(lake, "write_table", seen)
    r = run_layers(spark, sf_small, str(tmp_path / "lake"), until="silver", stop_on_error=False)
    assert shuffles_left() == 0 and readings() == before
    pieces = [df for name, df in written if name == "fct_sales_costed"]
    assert [[x[0] for x in df.select("channel").distinct().collect()] for df in pieces] == [["physical"], ["online"]]
    assert r.tables["fct_sales_costed"].count() == sum(df.count() for df in pieces)
