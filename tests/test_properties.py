"""Property tests on generated inputs (small, many cases)."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.asof import asof_join
from ledgerloom.operators.dimensions import close_intervals
from ledgerloom.operators.facts import cost_sales
from ledgerloom.operators.marts import negative_margin, streak_scenarios, stockout_streaks

BASE = date(2026, 1, 1)
CUTOFF = date(2026, 3, 31)
FAST = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

day = st.integers(min_value=0, max_value=200)
reading = st.one_of(st.none(), st.integers(min_value=0, max_value=2))


@FAST
@given(
    changes=st.lists(st.tuples(st.integers(1, 3), day, st.integers(1, 9)), min_size=1, max_size=8),
    sales=st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 4)), day, st.integers(-3, 3)), min_size=1, max_size=15),
)
def test_asof_join_keeps_every_fact_row_once(spark, changes, sales):
    costs = close_intervals(
        spark.createDataFrame(
            [(k, BASE + timedelta(days=d), float(c)) for k, d, c in changes], "product_key bigint, valid_from date, cost double"
        )
    )
    facts = spark.createDataFrame(
        [(i, k, BASE + timedelta(days=d), u, 10.0) for i, (k, d, u) in enumerate(sales)],
        "doc bigint, product_key bigint, date date, units int, amount double",
    )
    out = cost_sales(facts, costs)
    assert out.count() == len(sales)
    assert out.select(F.countDistinct("doc")).first()[0] == len(sales)
    expected = sorted(map(tuple, out.select("doc", "cost").collect()))
    salted = cost_sales(facts, costs, salt=3)
    assert sorted(map(tuple, salted.select("doc", "cost").collect())) == expected
    for salt in (1, 4):
        windowed = cost_sales(facts, costs, strategy="window", salt=salt)
        assert sorted(map(tuple, windowed.select("doc", "cost").collect())) == expected


def _series(spark, patterns):
    rows = []
    for store, pattern in enumerate(patterns):
        for i, u in enumerate(pattern):
            if u == "gap":
                continue
            rows.append((1, BASE + timedelta(days=i), f"S{store}", u, u is not None))
    return spark.createDataFrame(rows, "product_key bigint, date date, store_id string, units int, reading_valid boolean")


patterns = st.lists(st.lists(st.one_of(reading, st.just("gap")), min_size=1, max_size=25), min_size=1, max_size=3)


@FAST
@given(patterns=patterns)
def test_with_min_days_zero_streak_days_add_up_to_valid_zero_days(spark, patterns):
    inv = _series(spark, patterns)
    zero_days = inv.where(F.col("reading_valid") & (F.col("units") == 0)).count()
    runs = streak_scenarios(inv, CUTOFF, min_days=0)
    total = runs.where(F.col("scenario") == "unknown_breaks").agg(F.sum("days")).first()[0] or 0
    bridged = runs.where(F.col("scenario") == "unknown_bridged").agg(F.sum("days")).first()[0] or 0
    assert total == zero_days == bridged


@FAST
@given(patterns=patterns)
def test_breaks_days_are_covered_by_the_other_scenarios(spark, patterns):
    """Every day of a long "breaks" run lies inside a long run of the two
    other treatments (runs may merge there, so compare days, not run counts)."""
    inv = _series(spark, patterns)
    days = {
        r["scenario"]: r["d"]
        for r in streak_scenarios(inv, CUTOFF, min_days=3).groupBy("scenario").agg(F.sum("days").alias("d")).collect()
    }
    breaks = days.get("unknown_breaks", 0)
    assert breaks <= days.get("unknown_bridged", 0)
    assert breaks <= days.get("unknown_as_zero", 0)


@FAST
@given(patterns=patterns)
def test_detail_matches_scenario_breaks(spark, patterns):
    inv = _series(spark, patterns)
    prods = spark.createDataFrame([(1, "CN-00001", "x", "y")], "product_key bigint, sku_pos string, name string, category string")
    stores = spark.createDataFrame([(f"S{i}", "c", "r") for i in range(3)], "store_id string, city string, region string")
    detail = sorted((r["store_id"], r["consecutive_days"]) for r in stockout_streaks(inv, prods, stores, CUTOFF).collect())
    scen = sorted(
        (r["store_id"], r["days"])
        for r in streak_scenarios(inv, CUTOFF).where(F.col("scenario") == "unknown_breaks").collect()
    )
    assert detail == scen


@FAST
@given(
    lines=st.lists(
        st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["T1", "T2", "ONLINE"]), st.integers(0, 200), st.integers(-5, 5), st.one_of(st.none(), st.integers(-500, 500))),
        min_size=1,
        max_size=20,
    ),
    costs=st.lists(st.tuples(st.integers(1, 3), day, st.integers(1, 90)), min_size=1, max_size=6),
)
def test_store_rows_of_a_losing_product_sum_to_its_margin(spark, lines, costs):
    sales = spark.createDataFrame(
        [
            (k, "online" if s == "ONLINE" else "physical", BASE + timedelta(days=d), s, f"D{i}", True, u, None if a is None else Decimal(a))
            for i, (k, s, d, u, a) in enumerate(lines)
        ],
        "product_key bigint, channel string, date date, store_id string, doc_id string, is_revenue boolean, units int, amount decimal(28,8)",
    )
    versions = spark.createDataFrame([(k, BASE + timedelta(days=d), Decimal(c)) for k, d, c in costs], "product_key bigint, valid_from date, cost decimal(18,3)")
    prods = spark.createDataFrame([(k, f"CN-{k:05d}", "e", "n", "c") for k in (1, 2, 3)],
                                  "product_key bigint, sku_pos string, sku_erp string, name string, category string")
    stores = spark.createDataFrame([(s, "c", "r") for s in ("T1", "T2", "ONLINE")], "store_id string, city string, region string")
    by_product, by_store = (x.collect() for x in negative_margin(sales, close_intervals(versions), prods, stores, BASE + timedelta(days=180)))
    for r in by_product:
        own = [x for x in by_store if x["product_key"] == r["product_key"]]
        assert sum(x["margin"] or 0 for x in own) == pytest.approx(r["margin"], abs=1e-6)
        for n in ("units", "lines", "lines_without_cost", "lines_without_rate"):
            assert sum(x[n] for x in own) == r[n]


@FAST
@given(
    versions=st.lists(st.tuples(st.integers(1, 2), day, st.one_of(st.none(), day), st.integers(1, 9)), min_size=1, max_size=8),
    facts=st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 3)), day), min_size=1, max_size=15),
)
def test_both_asof_strategies_agree_on_overlapping_versions(spark, versions, facts):
    """The version started last counts while it lasts; the longer of two with one start, then the larger."""
    at = lambda d: None if d is None else BASE + timedelta(days=d)
    v = spark.createDataFrame([(k, at(a), at(z), float(c)) for k, a, z, c in versions], "product_key bigint, valid_from date, valid_to date, cost double")
    f = spark.createDataFrame([(i, k, at(d)) for i, (k, d) in enumerate(facts)], "doc bigint, product_key bigint, date date")
    want = []
    for i, (k, d) in enumerate(facts):
        found = [(a, 10**6 if z is None else z, c) for key, a, z, c in versions if key == k and a <= d]
        best = max(found, default=None)
        want.append((i, float(best[2]) if best and d <= best[1] else None))
    for strategy, salt in (("range", 1), ("range", 3), ("window", 1), ("window", 2)):
        got = asof_join(f, v, "product_key", "date", ["cost"], strategy=strategy, salt=salt)
        assert sorted(map(tuple, got.select("doc", "cost").collect())) == want
