"""Every catalogue query against its independent SQL oracle (DuckDB), exact."""

from __future__ import annotations

import importlib
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "tools"))

from ledgerloom.plans import catalog

entry = importlib.import_module("__spark_entry__")
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def duck(sf_small):
    duckdb = pytest.importorskip("duckdb")
    from oracle_check import duck as connect

    return connect(sf_small)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, duck, name):
    from oracle_check import digest, duck_types, spark_types

    sdf = entry.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert spark_types(sdf) == duck_types(duck, entry.oracle_sql()[name])
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "margin" in df.columns
