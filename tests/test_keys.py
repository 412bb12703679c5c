"""Conformed product key and mapping validation (hand cases)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.keys import format_sku, key_from_erp, key_from_handle, key_from_pos, zero_pad
from ledgerloom.operators.keys import mapping_discrepancies


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("k")).first()["k"]


@pytest.mark.parametrize(
    "text, expected",
    [("CN-00015", 15), ("  CN-00007  ", 7), ("CN-7", 7), ("SKU-00015", None), ("CN-ABCDE", None),
     (None, None), ("CN-00000", 0), ("", None)],
)
def test_key_from_pos(spark, text, expected):
    assert _one(spark, key_from_pos, text) == expected


@pytest.mark.parametrize(
    "text, expected", [("ERP-PROV-MX-018-A", 18), ("ERP-PROV-018", None), (None, None), ("ERP-PROV-MX-0042-B", 42)]
)
def test_key_from_erp(spark, text, expected):
    assert _one(spark, key_from_erp, text) == expected


@pytest.mark.parametrize(
    "text, expected", [("mug-ceramic-039", 39), ("no-number", None), (None, None), ("mug-7", 7)]
)
def test_key_from_handle(spark, text, expected):
    assert _one(spark, key_from_handle, text) == expected


def test_key_parse_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    # a number too large for BIGINT is NULL, not an error
    assert _one(spark, key_from_pos, "CN-" + "9" * 30) is None


@pytest.mark.parametrize("key, sku", [(7, "CN-00007"), (12345, "CN-12345"), (100000, "CN-100000"), (1234567, "CN-1234567")])
def test_generated_sku_never_truncates(spark, key, sku):
    """D9: lpad(key, 5) would cut 100000 to '10000' and collide with key 10000."""
    assert _one(spark, format_sku, key, "bigint") == sku


def test_zero_pad_matches_printf(spark):
    rows = spark.createDataFrame([(v,) for v in [0, 5, 42, 999, 1000, 123456, -3]], "n bigint")
    out = rows.select("n", zero_pad("n", 3).alias("p"), F.format_string("%03d", "n").alias("f")).collect()
    assert all(r["p"] == r["f"] for r in out)


MAP_SCHEMA = "sku_pos string, sku_erp string, handle string"


def test_mapping_accepts_null_erp_or_handle(spark):
    m = spark.createDataFrame(
        [("CN-00071", None, "jar-071"), ("CN-00082", "ERP-PROV-MX-082-A", None), ("CN-00640", "ERP-PROV-MX-640-A", "q-640")],
        MAP_SCHEMA,
    )
    assert mapping_discrepancies(m).count() == 0


def test_mapping_rejects_contradiction(spark):
    m = spark.createDataFrame(
        [("CN-00131", "ERP-PROV-MX-113-D", "lid-131"), ("CN-00250", "ERP-PROV-MX-250-A", "lid-250")], MAP_SCHEMA
    )
    rows = mapping_discrepancies(m).collect()
    assert len(rows) == 1
    assert (rows[0]["key_pos"], rows[0]["key_erp"]) == (131, 113)


def test_mapping_rejects_unparseable_pos_sku(spark):
    m = spark.createDataFrame([("SKU-1", None, None)], MAP_SCHEMA)
    assert mapping_discrepancies(m).count() == 1
