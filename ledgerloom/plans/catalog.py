"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Money leaves as DOUBLE (exact decimal, converted last); counts as BIGINT;
dates as DATE; no wall-clock column is ever returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import key_from_erp, key_from_handle, key_from_pos
from ..functions.money import UNIT_COST, money_out
from ..operators import anchors as anc
from ..operators import checks as chk
from ..operators import marts
from ..operators import streak_months as summaries
from ..operators.dimensions import calendar, close_intervals, fx_dimension
from ..operators.facts import POS_RAW, cost_sales, dedup_documents, settle_readings, value_inventory
from ..operators.keys import mapping_discrepancies
from ..operators.splice import splice_intervals
from ..sources import feeds
from ..sources import files as src
from ..sources import lake
from ..sources.buckets import SALT, write_bucketed
from ..sources.footers import footer_cutoff
from . import bindings as b
from .incremental import SalesLake
from .model import RetailModel

Query = Callable[[SparkSession, str], DataFrame]

#: Numbers over which the rows of one product are dealt in bucketed facts.
BUCKET_SALT = 8

#: Columns of the costed sales that the checks of a report read.
CHECKED_SALES = ["doc_id", "channel", "date", "store_id", "product_key", "is_revenue", "units", "amount", "cost"]


def _m(spark: SparkSession, sf_dir: str) -> RetailModel:
    return RetailModel(spark, sf_dir)


def _fact_out(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", "channel", "date", "store_id", "product_key", "doc_type", "is_revenue", "units",
        F.col("amount").cast("double").alias("amount"), "currency",
        F.col("amount_src").cast("double").alias("amount_src"),
    )


# ------------------------------------------------------------------ sources, sinks
def csv_strict_roundtrip(spark, sf_dir):
    m = _m(spark, sf_dir)
    path = lake.scratch_path(spark, "pos-csv")
    (
        m.pos_raw.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    df = feeds.read_sales_csv(spark, path)
    return df.withColumn("amount", F.col("amount").cast("double"))


def csv_rejected_rows(spark, sf_dir):
    """The sales feed with bad rows (fourth lines with a text for their units; lines of orders divisible
    by 50 without store): what was rejected and why, by document."""
    pos = _m(spark, sf_dir).pos_raw
    line, order = F.substring_index("doc_id", "-", -1), F.substring_index("doc_id", "-", 1).cast("long")
    sent = pos.withColumns({
        "units": F.when(line == "4", "n/a").otherwise(F.col("units").cast("string")),
        "store_id": F.when(order % 50 != 0, F.col("store_id")),
    })
    path = lake.scratch_path(spark, "pos-bad-csv")
    lake.export_csv(sent, path)
    good, bad = src.read_sorting_out(spark, path, feeds.ddl(feeds.POS_CSV), feeds.POS_CSV.names)
    kept = good.select("doc_id", F.lit("accepted").alias("reason"))
    lost = bad.select(F.regexp_extract("raw", "^([^,]*)", 1).alias("doc_id"), "reason")
    return kept.unionByName(lost).groupBy("doc_id", "reason").agg(F.count(F.lit(1)).alias("rows"))


def fx_csv_dimension(spark, sf_dir):
    """The FX feed as it arrives (text CSV: date as text), read strictly and
    conformed: parsed dates, normalised currencies, identity rate added."""
    m = _m(spark, sf_dir)
    path = lake.scratch_path(spark, "fx-csv")
    text = m.fx_raw.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "currency", "rate")
    lake.export_csv(text, path)
    fx = fx_dimension(feeds.read_fx_csv(spark, path))
    return fx.select("date", "currency", F.col("rate").cast("double").alias("rate"))


def parquet_projected(spark, sf_dir):
    return src.read_parquet_projected(
        spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_nationkey", "c_mktsegment"]
    )


def _erp_table(spark, documents: DataFrame, name: str, multiline: bool = False) -> DataFrame:
    """One table of ERP documents that were written and read again."""
    path = lake.scratch_path(spark, f"erp-{name}-json")
    if multiline:  # one document for each file
        documents.select("block", F.to_json(F.struct(name)).alias("value")).write.partitionBy("block").text(path)
    else:
        documents.write.mode("overwrite").json(path)
    return src.assert_nonempty(feeds.read_erp_documents(spark, path, multiline)[name], f"ERP {name}")


def _costs_out(catalog_table: DataFrame) -> DataFrame:
    flat = src.explode_array(catalog_table, "cost_history", keep=["sku_erp", "name", "category"])
    return flat.select("sku_erp", "name", "category", "valid_from", F.col("cost").cast("double").alias("cost"), "supplier")


def json_explode_snapshots(spark, sf_dir):
    """One JSON document per store and month, read back FAILFAST, exploded."""
    return _erp_table(spark, b.snapshot_documents(_m(spark, sf_dir).snapshots_raw), "snapshots")


def json_document_stores(spark, sf_dir):
    return _erp_table(spark, b.single_documents(_m(spark, sf_dir).stores_raw, "stores"), "stores")


def json_document_mappings(spark, sf_dir):
    return _erp_table(spark, b.single_documents(_m(spark, sf_dir).mappings_raw, "mappings"), "mappings")


def json_explode_nested_costs(spark, sf_dir):
    """Catalogue documents with a nested cost history, flattened two levels."""
    return _costs_out(_erp_table(spark, b.single_documents(_m(spark, sf_dir).catalog_raw, "catalog"), "catalog"))


def json_multiline_catalog(spark, sf_dir):
    """The same from documents that span lines, one file for each block of products."""
    return _costs_out(_erp_table(spark, b.catalog_documents(_m(spark, sf_dir).catalog_raw), "catalog", multiline=True))


def json_document_ranges(spark, sf_dir):
    """One document with all stores, mappings, products and snapshots, read in byte ranges."""
    m = _m(spark, sf_dir)
    path = lake.scratch_path(spark, "erp-document")
    day = F.date_format("date", "yyyy-MM-dd").alias("date")
    b.write_erp_document({
        "stores": m.stores_raw, "mappings": m.mappings_raw, "catalog": m.catalog_raw,
        "snapshots": m.snapshots_raw.select(day, "store_id", "sku_erp", "stock"),
    }, path)
    erp = feeds.read_erp_documents(spark, path, ranges=True)
    costs = src.explode_array(erp["catalog"], "cost_history", keep=["sku_erp", "name", "category"])

    def rows(name: str, table: DataFrame, key: str, *details) -> DataFrame:
        return table.select(F.lit(name).alias("array"), F.col(key).alias("id"), F.concat_ws("|", *details).alias("detail"))

    return (
        rows("stores", erp["stores"], "store_id", "city", "region", "timezone")
        .unionByName(rows("mappings", erp["mappings"], "handle", "sku_pos", "sku_erp"))
        .unionByName(rows("catalog", costs, "sku_erp", "name", "category", "valid_from", F.col("cost").cast("string"), "supplier"))
        .unionByName(rows("snapshots", erp["snapshots"], "store_id", "date", "sku_erp", "stock"))
    )


def lineage_stamp(spark, sf_dir):
    stamped = src.stamp_lineage(_m(spark, sf_dir).pos_raw, "pos:lineitem")
    return stamped.select("doc_id", "store_id", "sku", "_source")


def partitioned_parquet_roundtrip(spark, sf_dir):
    """Sales fact written partitioned by month, read back with a month filter
    that prunes partitions (last 12 months to the cutoff)."""
    m = _m(spark, sf_dir)
    path = lake.scratch_path(spark, "fct-sales")
    fact = _fact_out(m.sales).withColumn("month", F.date_format("date", "yyyy-MM"))
    lake.write_table(fact, path, partition_by=["month"])
    first = anc.month_start(m.sales_cutoff, 12).strftime("%Y-%m")
    return lake.read_table(spark, path).where(F.col("month") >= first)


def csv_export_roundtrip(spark, sf_dir):
    m = _m(spark, sf_dir)
    growth = marts.growth_by_channel(m.sales, m.sales_cutoff)
    path = lake.scratch_path(spark, "mom-csv")
    lake.export_csv(growth, path, single_file=True)  # channels x months: bounded
    schema = (
        "channel string, month string, revenue double, units bigint, documents bigint, "
        "prev_revenue double, growth_pct double, avg_ticket double"
    )
    return src.read_csv_strict(spark, path, schema)


# ------------------------------------------------------------------ keys, dimensions
def key_extract_pos(spark, sf_dir):
    raw = _m(spark, sf_dir).pos_raw
    return raw.select("sku", key_from_pos("sku").alias("product_key")).distinct()


def key_extract_erp(spark, sf_dir):
    snaps = _m(spark, sf_dir).snapshots_raw.select("sku_erp")
    return snaps.select("sku_erp", key_from_erp("sku_erp").alias("product_key")).distinct()


def key_extract_handle(spark, sf_dir):
    m = _m(spark, sf_dir)
    handles = m.online_raw.select("handle").unionByName(m.mappings_raw.select("handle"))
    return handles.select("handle", key_from_handle("handle").alias("product_key")).distinct()


def mapping_discrepancies_q(spark, sf_dir):
    return mapping_discrepancies(_m(spark, sf_dir).mappings_raw)


def dim_store_with_online(spark, sf_dir):
    return _m(spark, sf_dir).stores


def dim_product_alias_fallback(spark, sf_dir):
    return _m(spark, sf_dir).products


def scd2_intervals(spark, sf_dir):
    c = _m(spark, sf_dir).cost
    return c.select("product_key", "valid_from", "valid_to", F.col("cost").cast("double").alias("cost"), "supplier")


def scd2_spliced(spark, sf_dir):
    """Intervals of an older state of the catalogue (no first change, the second one at double cost), and
    the changes that two products in three got since: the first change late, the second
    corrected, the last deleted."""
    versions = _m(spark, sf_dir).cost.select("product_key", "valid_from", "cost", "supplier")
    second = F.col("supplier") == "SUP-2"
    older = versions.where("supplier <> 'SUP-1'").withColumn("cost", F.when(second, F.col("cost") * 2).otherwise(F.col("cost")).cast(UNIT_COST))
    intervals = close_intervals(older)
    sent = versions.where("product_key % 3 <> 0 and supplier in ('SUP-1', 'SUP-2', 'SUP-4')")
    changes = sent.withColumn("deleted", F.col("supplier") == "SUP-4")
    spliced = splice_intervals(intervals, changes, ["cost", "supplier"])
    rest = intervals.join(changes.select("product_key").distinct(), "product_key", "left_anti")
    both = rest.unionByName(spliced)
    return both.select("product_key", "valid_from", "valid_to", F.col("cost").cast("double").alias("cost"), "supplier")


def fx_dimension_identity(spark, sf_dir):
    fx = _m(spark, sf_dir).fx
    return fx.select("date", "currency", F.col("rate").cast("double").alias("rate"))


def calendar_days(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem")
    bounds = li.agg(F.min(F.to_date("l_shipdate")).alias("lo"), F.max(F.to_date("l_shipdate")).alias("hi"))
    return calendar(bounds)


# ------------------------------------------------------------------ facts
def document_sign_totals(spark, sf_dir):
    pos = _m(spark, sf_dir).pos
    return pos.groupBy("doc_type").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("is_revenue").cast("int")).cast("long").alias("revenue_lines"),
        F.sum("units").cast("long").alias("units"),
        money_out(F.sum("amount_src")).alias("amount_src"),
    )


def sales_fact_pos(spark, sf_dir):
    return _fact_out(_m(spark, sf_dir).pos)


def dedup_by_document(spark, sf_dir):
    """Documents sent more than once: copies and the surviving line."""
    raw = _m(spark, sf_dir).pos_raw
    copies = raw.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    kept = dedup_documents(raw, "doc_id", POS_RAW)
    return copies.join(kept, "doc_id").select(
        "doc_id", "copies", F.to_date("ts").alias("date"), "store_id", "sku", "units",
        F.col("amount").cast("double").alias("amount"), "currency", "doc_type",
    )


def sales_fact_online_fx(spark, sf_dir):
    return _fact_out(_m(spark, sf_dir).online)


def sales_unified_by_channel(spark, sf_dir):
    s = _m(spark, sf_dir).sales
    return s.groupBy("channel", "currency").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("units").cast("long").alias("units"),
        money_out(F.sum("amount")).alias("amount"),
        money_out(F.sum("amount_src")).alias("amount_src"),
        F.sum(F.col("amount").isNull().cast("int")).cast("long").alias("lines_without_rate"),
    )


def inventory_readings_q(spark, sf_dir):
    return _m(spark, sf_dir).inventory


def dedup_by_grain(spark, sf_dir):
    m = _m(spark, sf_dir)
    grain = ["date", "store_id", "product_key"]
    copies = m.readings.groupBy(*grain).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return copies.join(m.inventory, grain).select(*grain, "copies", "units", "reading_valid")


def inventory_valued_asof(spark, sf_dir):
    return _valued_out(_m(spark, sf_dir).valued)


def inventory_valued_bucketed(spark, sf_dir):
    """O19 on stored facts: readings bucketed by product and salt meet the costs where they lie."""
    m = _m(spark, sf_dir)
    stored = write_bucketed(m.inventory, lake.scratch_path(spark, "buckets"), ["product_key"], salt=BUCKET_SALT)
    return _valued_out(value_inventory(stored.table, m.cost, salt=stored.salt, salted_by=SALT))


def _valued_out(v: DataFrame) -> DataFrame:
    return v.select(
        "date", "store_id", "product_key", "units", "reading_valid",
        F.col("cost").cast("double").alias("cost"), F.col("value").cast("double").alias("value"),
    )


def sales_costed_asof(spark, sf_dir):
    return _costed_out(_m(spark, sf_dir).costed)


def sales_costed_asof_window(spark, sf_dir):
    """O20 with the pair-free as-of strategy (sort-based, key x salt)."""
    m = _m(spark, sf_dir)
    return _costed_out(cost_sales(m.sales, m.cost, strategy="window", salt=4))


def sales_costed_bucketed(spark, sf_dir):
    """O20 on stored facts: sales bucketed by product and salt meet the costs where they lie."""
    m = _m(spark, sf_dir)
    stored = write_bucketed(m.channels, lake.scratch_path(spark, "buckets"), ["product_key"], salt=BUCKET_SALT)
    return _costed_out(cost_sales(stored.table, m.cost, salt=stored.salt, salted_by=SALT))


def sales_incremental(spark, sf_dir):
    """O43 by batches: the feeds arrive in three loads with documents sent again, quotes and cost versions
    late; the costed sales are those of a full run."""
    m = _m(spark, sf_dir)
    store = SalesLake(spark, lake.scratch_path(spark, "incremental"))
    costs = m.cost.select("product_key", "valid_from", "cost", "supplier", F.lit(False).alias("deleted"))

    def share(df: DataFrame, k: int, *by: str) -> DataFrame:
        return df.where(F.pmod(F.xxhash64(*by), F.lit(3)) == k)

    for k in range(3):
        store.load(
            f"batch-{k}", share(m.pos_raw, k, "doc_id", "ts", "sku", "units"), share(m.online_raw, k, "order_id"),
            share(m.fx_raw, k, "date", "currency"), share(costs, k, "product_key", "valid_from"),
        )
        store.lake.expire(keep=1)  # nobody reads the lake between its loads
    return _costed_out(store.costed())


def _costed_out(c: DataFrame) -> DataFrame:
    return c.select(
        "doc_id", "channel", "date", "product_key", "is_revenue", "units",
        F.col("amount").cast("double").alias("amount"),
        F.col("cost").cast("double").alias("cost"),
        F.col("cost_total").cast("double").alias("cost_total"),
        F.col("margin").cast("double").alias("margin"),
    )


# ------------------------------------------------------------------ time anchors
def _cutoff_frame(spark, sf_dir):
    m = _m(spark, sf_dir)
    return anc.cutoff_frame([(m.pos_raw, "ts"), (m.online_raw, "ts")])


def cutoff_date(spark, sf_dir):
    return _cutoff_frame(spark, sf_dir)


def cutoff_from_footers(spark, sf_dir):
    """Both cutoffs of a stored lake, from file footers."""
    m = _m(spark, sf_dir)
    found = []
    for name, facts in (("sales", m.sales.select("date", "doc_id")), ("stock", m.inventory)):
        path = lake.scratch_path(spark, f"dated-{name}")
        lake.write_table(facts, path)
        found.append(footer_cutoff(spark, [(path, "date")]))
    return spark.createDataFrame([tuple(found)], "sales_cutoff date, stock_cutoff date")


def checks_from_footers(spark, sf_dir):
    path = lake.scratch_path(spark, "stock")
    lake.write_table(_m(spark, sf_dir).inventory, path)
    return chk.inventory_checks_from_footers(spark, path)


def month_window_bounds(spark, sf_dir):
    c = _cutoff_frame(spark, sf_dir).select("cutoff", F.explode(F.array(*[F.lit(n) for n in (1, 3, 6, 12)])).alias("months"))
    return c.select(
        "cutoff", "months",
        anc.month_start_col(F.col("cutoff"), F.col("months")).alias("window_start"),
        F.col("cutoff").alias("window_end"),
    )


def quarter_window_bounds(spark, sf_dir):
    m = _m(spark, sf_dir)
    sales = anc.cutoff_frame([(m.pos_raw, "ts"), (m.online_raw, "ts")]).select(F.lit("sales").alias("source"), "cutoff")
    stock = anc.cutoff_frame([(b.shelf_snapshots(spark, sf_dir), "date")]).select(
        F.lit("stock").alias("source"), "cutoff"
    )
    both = sales.unionByName(stock)
    return both.select(
        "source", "cutoff",
        anc.quarter_start_col(F.col("cutoff")).alias("quarter_start"),
        anc.quarter_label_col(F.col("cutoff")).alias("quarter"),
    )


# ------------------------------------------------------------------ marts
def inventory_turnover_topn(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.inventory_turnover(m.sales, m.inventory, m.cost, m.products, m.sales_cutoff)


def stockout_streaks(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.stockout_streaks(m.inventory, m.products, m.stores, m.stock_cutoff)


def stockout_by_store(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.stockout_by_store(marts.stockout_streaks(m.inventory, m.products, m.stores, m.stock_cutoff))


def zero_days_by_store(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.zero_days_by_store(m.inventory, m.stores, m.stock_cutoff)


def _scenario(name: str) -> Query:
    def q(spark, sf_dir):
        m = _m(spark, sf_dir)
        runs = marts.streak_scenarios(m.inventory, m.stock_cutoff)
        return runs.where(F.col("scenario") == name).select("store_id", "product_key", "days")

    q.__name__ = f"streaks_{name}"
    return q


def streaks_history(spark, sf_dir):
    """Runs over all days, from month summaries that are stored by month and merged."""
    path = lake.scratch_path(spark, "streak-months")
    lake.write_table(summaries.month_summaries(_m(spark, sf_dir).inventory), path, ["month"])
    return summaries.runs_of(summaries.merge_history(lake.read_table(spark, path)))


def streak_sensitivity(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.streak_sensitivity(m.inventory, m.stock_cutoff)


def mom_growth_by_channel(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.growth_by_channel(m.sales, m.sales_cutoff)


def negative_margin_product(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.negative_margin(m.sales, m.cost, m.products, m.stores, m.sales_cutoff)[0]


def negative_margin_product_store(spark, sf_dir):
    m = _m(spark, sf_dir)
    return marts.negative_margin(m.sales, m.cost, m.products, m.stores, m.sales_cutoff)[1]


# ------------------------------------------------------------------ checks
def _one_check(name: str, build: Callable[[RetailModel], DataFrame]) -> Query:
    def q(spark, sf_dir):
        return build(_m(spark, sf_dir)).where(F.col("check") == name)

    return q


def quality_report(spark, sf_dir):
    """All checks of a run. The conformed feeds are written once and read back, so each raw feed
    is conformed once and each fact scanned once for its checks. Sales are costed and written channel by channel, with
    the columns that some check reads."""
    m = _m(spark, sf_dir)

    def kept(name: str, *pieces: DataFrame) -> DataFrame:
        path = lake.scratch_path(spark, f"report-{name}")
        lake.write_pieces(pieces, path)
        return lake.read_table(spark, path)

    sales = kept("costed", *(cost_sales(sales, m.cost).select(*CHECKED_SALES) for sales in m.channels))
    readings = kept("readings", m.readings)
    inventory = kept("inventory", settle_readings(readings))
    checks = [
        chk.check_mapping(m.mappings_raw),
        chk.sales_checks(sales, m.products, stores=m.stores),
        chk.check_document_types(m.pos_raw),
        chk.inventory_checks(inventory),
        chk.check_grain_unique(readings),
        chk.check_revenue_positive(marts.growth_by_channel(sales, m.sales_cutoff)),
        chk.check_turnover_valid(marts.inventory_turnover(sales.drop("cost"), inventory, m.cost, m.products, m.sales_cutoff)),
    ]
    return chk.quality_report(checks, m.sales_cutoff)


def quality_gate(spark, sf_dir):
    return chk.quality_gate(quality_report(spark, sf_dir))


def layered_negative_margin_product(spark, sf_dir):
    """O43: the whole layered run (bronze, silver, checks, gold written to a
    scratch lake and read back); returns the gold negative-margin table."""
    from .layers import run_layers

    result = run_layers(spark, sf_dir, stop_on_error=False)
    return result.tables["negative_margin_product"]


def queries() -> dict[str, Query]:
    return {
        "csv_strict_roundtrip": csv_strict_roundtrip,
        "csv_rejected_rows": csv_rejected_rows,
        "fx_csv_dimension": fx_csv_dimension,
        "parquet_projected": parquet_projected,
        "json_explode_snapshots": json_explode_snapshots,
        "json_explode_nested_costs": json_explode_nested_costs,
        "json_document_stores": json_document_stores,
        "json_document_mappings": json_document_mappings,
        "json_multiline_catalog": json_multiline_catalog,
        "json_document_ranges": json_document_ranges,
        "lineage_stamp": lineage_stamp,
        "partitioned_parquet_roundtrip": partitioned_parquet_roundtrip,
        "csv_export_roundtrip": csv_export_roundtrip,
        "key_extract_pos": key_extract_pos,
        "key_extract_erp": key_extract_erp,
        "key_extract_handle": key_extract_handle,
        "mapping_discrepancies": mapping_discrepancies_q,
        "dim_store_with_online": dim_store_with_online,
        "dim_product_alias_fallback": dim_product_alias_fallback,
        "scd2_intervals": scd2_intervals,
        "scd2_spliced": scd2_spliced,
        "fx_dimension_identity": fx_dimension_identity,
        "calendar_days": calendar_days,
        "document_sign_totals": document_sign_totals,
        "sales_fact_pos": sales_fact_pos,
        "dedup_by_document": dedup_by_document,
        "sales_fact_online_fx": sales_fact_online_fx,
        "sales_unified_by_channel": sales_unified_by_channel,
        "inventory_readings": inventory_readings_q,
        "dedup_by_grain": dedup_by_grain,
        "inventory_valued_asof": inventory_valued_asof,
        "sales_costed_asof": sales_costed_asof,
        "sales_costed_asof_window": sales_costed_asof_window,
        "sales_costed_bucketed": sales_costed_bucketed,
        "inventory_valued_bucketed": inventory_valued_bucketed,
        "sales_incremental": sales_incremental,
        "cutoff_date": cutoff_date,
        "cutoff_from_footers": cutoff_from_footers,
        "month_window_bounds": month_window_bounds,
        "quarter_window_bounds": quarter_window_bounds,
        "inventory_turnover_topn": inventory_turnover_topn,
        "stockout_streaks": stockout_streaks,
        "stockout_by_store": stockout_by_store,
        "zero_days_by_store": zero_days_by_store,
        "streaks_unknown_breaks": _scenario("unknown_breaks"),
        "streaks_unknown_bridged": _scenario("unknown_bridged"),
        "streaks_unknown_as_zero": _scenario("unknown_as_zero"),
        "streak_sensitivity": streak_sensitivity,
        "streaks_history": streaks_history,
        "mom_growth_by_channel": mom_growth_by_channel,
        "negative_margin_product": negative_margin_product,
        "negative_margin_product_store": negative_margin_product_store,
        "check_mapping": _one_check("mapping_consistent", lambda m: chk.check_mapping(m.mappings_raw)),
        "check_orphan_sales": _one_check("sales_have_product", lambda m: chk.sales_checks(m.sales, m.products)),
        "check_missing_fx": _one_check("amounts_converted", lambda m: chk.sales_checks(m.sales, m.products)),
        "check_sign": _one_check("sign_coherent", lambda m: chk.sales_checks(m.sales, m.products)),
        "check_invalid_readings": _one_check("readings_valid", lambda m: chk.inventory_checks(m.inventory)),
        "check_grain_unique": _one_check("grain_unique", lambda m: chk.check_grain_unique(m.readings)),
        "check_non_negative": _one_check("stock_not_negative", lambda m: chk.inventory_checks(m.inventory)),
        "checks_from_footers": checks_from_footers,
        "check_revenue_positive": _one_check(
            "monthly_revenue_positive",
            lambda m: chk.check_revenue_positive(marts.growth_by_channel(m.sales, m.sales_cutoff)),
        ),
        "check_turnover_valid": _one_check(
            "turnover_valid",
            lambda m: chk.check_turnover_valid(
                marts.inventory_turnover(m.sales, m.inventory, m.cost, m.products, m.sales_cutoff)
            ),
        ),
        "check_orphan_store": _one_check("sales_have_store", lambda m: chk.check_sales_have_store(m.sales, m.stores)),
        "check_unknown_doc_types": _one_check("document_types_known", lambda m: chk.check_document_types(m.pos_raw)),
        "check_cost_covered": _one_check("cost_covered", lambda m: chk.check_cost_covered(m.costed)),
        "quality_report": quality_report,
        "quality_gate": quality_gate,
        "layered_negative_margin_product": layered_negative_margin_product,
    }


__all__ = ["queries"]
