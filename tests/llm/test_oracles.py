"""Queries that SQL can express against DuckDB, and the catalogue itself."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

from ledgerloom.llm import catalog, sql

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in catalog.queries()] == [f"op{i}" for i in range(1, 14)]
    assert set(sql.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, name):
    pytest.importorskip("duckdb")
    from oracle_check import digest, duck, spark_types, duck_types

    con = duck(sf_small)
    df = catalog.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql.oracle_sql()[name])
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert spark_types(df) == duck_types(con, sql.oracle_sql()[name])
    assert len(rows) == len(want) > 0
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]
