"""Answers from file footers against those from the rows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks
from ledgerloom.operators.anchors import resolve_cutoff
from ledgerloom.sources import footers

STOCK = "date date, store_id string, product_key bigint, units int, reading_valid boolean"


def stored(spark, path, units, parts=3):
    rows = [(date(2021, 1, 1) + timedelta(days=i), f"s{i}", i, u, u is not None) for i, u in enumerate(units)]
    spark.createDataFrame(rows, STOCK).repartition(parts).write.parquet(str(path))
    return str(path)


def test_bounds_come_from_footers(spark, tmp_path):
    path = stored(spark, tmp_path / "t", [3, None, 0, 7, None, 2])
    rows, found = footers.footer_bounds(spark, path, ["date", "units"])
    assert rows == 6 and found["units"] == (0, 7, 2) and found["date"] == (date(2021, 1, 1), date(2021, 1, 6), 0)
    plan = footers.footer_frame(spark, path, ["date", "units"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(date), MAX(date), COUNT(date)" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_what_footers_do_not_hold_is_read(spark, tmp_path):
    path = stored(spark, tmp_path / "t", [1, 2, None])
    assert footers.footer_bounds(spark, path, ["store_id", "units"]) == (3, {"store_id": ("s0", "s2", 0), "units": (1, 2, 1)})
    nulls = stored(spark, tmp_path / "n", [None, None, None, None], parts=1)
    assert footers.footer_bounds(spark, nulls, ["units"]) == (4, {"units": (None, None, 4)})
    empty = stored(spark, tmp_path / "e", [], parts=1)
    assert footers.footer_bounds(spark, empty, ["units", "date"]) == (0, {"units": (None, None, 0), "date": (None, None, 0)})


def test_cutoff(spark, tmp_path):
    a, b = stored(spark, tmp_path / "a", [1] * 5), stored(spark, tmp_path / "b", [1] * 9)
    empty = stored(spark, tmp_path / "e", [])
    want = resolve_cutoff([(spark.read.parquet(p), "date") for p in (a, b, empty)])
    assert footers.footer_cutoff(spark, [(a, "date"), (b, "date"), (empty, "date")]) == want == date(2021, 1, 9)
    with pytest.raises(ValueError):
        footers.footer_cutoff(spark, [(empty, "date")])


@pytest.mark.parametrize("units", [[1, 0, 4], [1, None, -2, -1], [None], []])
def test_checks(spark, tmp_path, units):
    path = stored(spark, tmp_path / "t", units)
    order = lambda df: sorted(map(tuple, df.select(checks.REPORT_COLUMNS).collect()))
    assert order(checks.inventory_checks_from_footers(spark, path)) == order(checks.inventory_checks(spark.read.parquet(path).where(F.lit(True))))
