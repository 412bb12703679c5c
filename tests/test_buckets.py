"""Bucketed facts: same rows as the plain joins, nothing of the facts exchanged, hot products dealt out."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.dimensions import close_intervals
from ledgerloom.operators.facts import cost_sales, value_inventory
from ledgerloom.plans import catalog
from ledgerloom.sources.buckets import SALT, read_bucketed, write_bucketed

ROWS = 9_000


def costs(spark):
    rows = [(k, date(2025, m, 1), float(k + m)) for k in (*range(1, 40), 7_777) for m in (1, 4, 6)]
    return close_intervals(spark.createDataFrame(rows, "product_key bigint, valid_from date, cost double"))


def facts(spark):
    """A third of all rows are one product, a ninth none; some dates lie before the first cost."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7_777)).when(F.col("id") % 9 == 1, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(ROWS).select(
        key.cast("bigint").alias("product_key"),
        F.date_add(F.lit(date(2024, 12, 1)), (F.col("id") % 300).cast("int")).alias("date"),
        (F.col("id") % 5).alias("units"), F.lit(10.0).alias("amount"), "id",
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sorted_merges(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("salt", [1, 8])
@pytest.mark.parametrize("buckets", [3, 16])
def test_costed_as_plain_and_no_fact_is_exchanged(spark, tmp_path, sorted_merges, salt, buckets):
    stored = write_bucketed(facts(spark), str(tmp_path / "t"), ["product_key"], buckets=buckets, salt=salt)
    got = cost_sales(stored.table, costs(spark), salt=stored.salt, salted_by=SALT)
    text = plan(got)
    facts_side = text[text.index("SortMergeJoin") :].split("\n+- ")[0]
    first = next(i for i, line in enumerate(text.splitlines()) if "SortMergeJoin" in line)
    left = []  # the lines below the join up to its second child
    for line in text.splitlines()[first + 1 :]:
        if line.lstrip(" :").startswith("+- ") and left and "FileScan" in left[-1]:
            break
        left.append(line)
    assert "Bucketed: true" in facts_side and "Bucketed: true" in "".join(left) and "Exchange" not in "".join(left)
    want = cost_sales(facts(spark), costs(spark)).select("id", "product_key", "cost", "margin")
    got = got.select("id", "product_key", "cost", "margin")
    assert got.count() == ROWS
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_plain_facts_are_exchanged(spark, tmp_path, sorted_merges):
    """The same plan over a plain table, so that the test above cannot pass for another reason."""
    facts(spark).write.parquet(str(tmp_path / "t"))
    text = plan(cost_sales(spark.read.parquet(str(tmp_path / "t")), costs(spark)))
    assert "Bucketed: true" not in text and "Exchange hashpartitioning(product_key" in text


def test_hot_product_lies_in_many_buckets(spark, tmp_path):
    stored = write_bucketed(facts(spark), str(tmp_path / "t"), ["product_key"], buckets=32, salt=16)
    sizes = [r["n"] for r in stored.table.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == ROWS and max(sizes) < ROWS / 6
    unsalted = write_bucketed(facts(spark), str(tmp_path / "u"), ["product_key"], buckets=32)
    sizes = [r["n"] for r in unsalted.table.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) >= ROWS // 3


def test_a_path_says_how_to_read_it(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(facts(spark), path, ["product_key", "date"], buckets=5, salt=4)
    again = read_bucketed(spark.newSession(), path)
    assert again[1:] == (("product_key", "date"), 5, 4)
    assert again.table.drop(SALT).exceptAll(facts(spark)).count() == 0 and again.table.count() == ROWS
    counted = again.table.groupBy("product_key", "date", SALT).count()
    assert "Exchange" not in plan(counted)


def test_values_of_readings(spark, tmp_path):
    stored = write_bucketed(facts(spark), str(tmp_path / "t"), ["product_key"], buckets=4, salt=3)
    got = value_inventory(stored.table, costs(spark), salt=3, salted_by=SALT).select("id", "value")
    want = value_inventory(facts(spark), costs(spark)).select("id", "value")
    assert got.exceptAll(want).count() == 0 and got.count() == ROWS


def test_pieces_make_one_table_and_leave_no_shuffle_files(spark, tmp_path, sorted_merges, shuffles_left):
    pieces = [facts(spark).where("id % 2 = 0"), facts(spark).where("id % 2 = 1").select(*reversed(facts(spark).columns))]
    stored = write_bucketed(pieces, str(tmp_path / "t"), ["product_key"], buckets=4, salt=3)
    assert shuffles_left() == 0
    assert stored.table.columns == [*facts(spark).columns, SALT]
    assert stored.table.drop(SALT).exceptAll(facts(spark)).count() == 0 and stored.table.count() == ROWS
    one = write_bucketed(facts(spark), str(tmp_path / "u"), ["product_key"], buckets=4, salt=3)
    assert one.table.exceptAll(stored.table).count() == 0
    assert "Exchange" not in plan(stored.table.groupBy("product_key", SALT).count())
    again = read_bucketed(spark.newSession(), str(tmp_path / "t"))
    assert again[1:] == (("product_key",), 4, 3) and again.table.count() == ROWS


def test_edge_cases(spark, tmp_path):
    odd = spark.createDataFrame([(1, "x"), (1, "x"), (None, None), (None, None)], "`my key` long, `Say \"it\"` string")
    stored = write_bucketed(odd, str(tmp_path / "odd"), ["my key"], buckets=2, salt=2)
    assert stored.table.drop(SALT).exceptAll(odd).count() == 0 and stored.table.count() == 4
    empty = write_bucketed(facts(spark).limit(0), str(tmp_path / "empty"), ["product_key"], buckets=4, salt=2)
    assert empty.table.count() == 0 and empty.table.columns[-1] == SALT
    with pytest.raises(ValueError, match=SALT):
        write_bucketed(stored.table, str(tmp_path / "again"), ["my key"], salt=2)
    with pytest.raises(ValueError, match="key"):
        write_bucketed(odd, str(tmp_path / "none"), [])
    with pytest.raises(Exception, match="(?i)non-empty"):
        write_bucketed(odd, str(tmp_path / "odd"), ["my key"])
    assert read_bucketed(spark, str(tmp_path / "odd")).table.count() == 4  # the refused write changed nothing
    odd.write.parquet(str(tmp_path / "plain/schema"))
    with pytest.raises(ValueError, match="names no buckets"):
        read_bucketed(spark, str(tmp_path / "plain"))
    odd.write.parquet(str(tmp_path / "dead/data"))  # a write that died before its schema
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_bucketed(spark, str(tmp_path / "dead"))
    with pytest.raises(ValueError, match="range"):
        cost_sales(stored.table, costs(spark), strategy="window", salted_by=SALT)


def test_query_reads_buckets(spark, sf_small, sorted_merges):
    for query in (catalog.sales_costed_bucketed, catalog.inventory_valued_bucketed):
        assert "Bucketed: true" in plan(query(spark, sf_small))
