"""Raw sources derived from the benchmark tables.

The benchmark tables carry no exchange rates, cost history or stock counts,
so each raw feed of the retail model is derived from them by a fixed,
deterministic rule (the SQL oracle derives the same rows independently):

* point-of-sale lines   <- ``lineitem`` (store = supplier; currency from the
  supplier's region; document type from return flag x line status)
* web orders            <- one document line per line of ``orders`` (one without units for
  an order without lines); currency from the customer's region
* FX rates              <- ``orders`` and ``lineitem``: per month and status a quote from the
  month's totals, published for every day of the month but Sundays
* catalogue + cost      <- ``part``; five cost versions per product, nested
* official mapping      <- ``part`` (incomplete and partly wrong on purpose)
* stores                <- ``supplier`` (shops) and ``customer`` (stock points)
* shelf stock readings  <- ``events``: per stock point, product (from the event id)
  and day, 'N/A' on a day with an error event, else the number of purchases
* dispatch stock counts <- ``lineitem``: one count per shipped line

Every feed is a plain DataFrame plan over the whole tables: no sampling, no
key ranges, no driver-side data.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import zero_pad
from ..operators.common import broadcast_if_small

# Fixed values of the derivation rules.
REGION_CURRENCY = {"AMERICA": "USD", "EUROPE": "EUR", "MIDDLE EAST": "GBP"}
DEFAULT_CURRENCY = "MXN"
# (return flag, line status) -> document type; flag A is income whatever the status.
DOC_TYPE_RULES = [("A", None, "I"), ("N", "F", "I"), ("N", "O", "T"), ("R", "F", "E"), ("R", "O", "P")]
COST_HISTORY_START = "1996-01-01"
COST_VERSIONS = 5
COST_STEP_DAYS = 500
SHELF_PRODUCTS = 3  # products on the shelf of every stock point
QUOTED = (("USD", 17), ("EUR", 20))  # currency and whole part of its rate
QUOTE_TEXT = {"F": "{}", "O": " {} ", "P": "{}"}  # order status -> how its quote writes the currency
# identifier layouts: prefix, zero-padded number (minimum width), suffix
STORE_ID = ("T", 4, "")
STOCK_POINT_ID = ("U", 4, "")
ERP_SKU = ("ERP-PROV-MX-", 3, "-A")
POS_SKU = ("CN-", 5, "")
HANDLE = ("item-", 3, "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ident(layout: tuple[str, int, str], num: Column | str) -> Column:
    """Identifier text from a number; NULL stays NULL."""
    prefix, width, suffix = layout
    return F.concat(F.lit(prefix), zero_pad(num, width), F.lit(suffix))


def nation_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> currency of its region (nation and region have a fixed
    size by definition, 25 and 5 rows: safe to broadcast)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    ccy = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in REGION_CURRENCY.items() for x in kv]), F.col("r_name")),
        F.lit(DEFAULT_CURRENCY),
    )
    return nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("nationkey"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        ccy.alias("currency"),
    )


def _doc_type(flag: Column, status: Column) -> Column:
    out = None
    for f, s, t in DOC_TYPE_RULES:
        cond = flag == f if s is None else (flag == f) & (status == s)
        out = F.when(cond, t) if out is None else out.when(cond, t)
    return out


def _line_amount() -> Column:
    price, discount = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
    return (price * (F.lit(1) - discount)).cast("decimal(18,4)")


def pos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-of-sale lines: ``doc_id, ts, store_id, sku, units, amount,
    currency, doc_type`` (doc ids repeat: the feed re-sends lines)."""
    li = table(spark, sf_dir, "lineitem")
    ccy = F.broadcast(nation_currency(spark, sf_dir).select("nationkey", "currency"))
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # grows with the data (10k suppliers per TPC-H scale unit): broadcast only behind a row-count check (a
    # footer-only count), else a merge join (AQE splits a hot supplier) that moves all lines. Two numbers a
    # row are half as large as a number and the text of the currency, which follows from the nation
    supp = broadcast_if_small(supp, rows=supp.count())
    j = li.join(supp, li["l_suppkey"] == supp["s_suppkey"], "left")
    j = j.join(ccy, j["s_nationkey"] == ccy["nationkey"], "left")
    sku = ident(POS_SKU, "l_partkey")
    # line 3 of every order arrives with blanks around the SKU (trimmed on read)
    sku = F.when(F.col("l_linenumber") == 3, F.concat(F.lit("  "), sku, F.lit(" "))).otherwise(sku)
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("doc_id"),
        F.col("l_shipdate").alias("ts"),
        ident(STORE_ID, "l_suppkey").alias("store_id"),
        sku.alias("sku"),
        F.col("l_quantity").cast("int").alias("units"),
        _line_amount().alias("amount"),
        "currency",
        _doc_type(F.col("l_returnflag"), F.col("l_linestatus")).alias("doc_type"),
    )


def online_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web orders: ``order_id, ts, handle, units, amount, currency``, one document line
    for each line of an order, with that line's product, units and amount. An order without
    lines is one document, numbered 0, of its total price, without product or units."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ccy = F.broadcast(nation_currency(spark, sf_dir).select("nationkey", "currency"))
    cust = broadcast_if_small(cust, rows=cust.count())
    # the nation is moved with an order, not the text of its currency
    head = orders.join(cust, orders["o_custkey"] == cust["c_custkey"], "left").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "c_nationkey"
    )
    j = li.join(head, li["l_orderkey"] == head["o_orderkey"], "right")
    j = j.join(ccy, j["c_nationkey"] == ccy["nationkey"], "left")
    total = F.when(F.col("l_orderkey").isNull(), F.col("o_totalprice").cast("decimal(18,4)"))
    return j.select(
        F.concat(F.lit("W"), F.col("o_orderkey").cast("string"), F.lit("-"), F.coalesce("l_linenumber", F.lit(0)).cast("string")).alias("order_id"),
        F.col("o_orderdate").alias("ts"),
        ident(HANDLE, "l_partkey").alias("handle"),
        F.col("l_quantity").cast("int").alias("units"),
        F.coalesce(total, _line_amount()).alias("amount"),
        "currency",
    )


@dataclass(frozen=True)
class Anchors:
    first_sale: date  # earliest sale date over both channels
    sales_cutoff: date  # latest sale date over both channels
    stock_cutoff: date  # latest shelf reading date


def sales_span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last sale date over both raw sales feeds (before dedup): one
    aggregate job reading two date columns, one row back."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    od = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    both = li.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).unionByName(
        od.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    )
    row = both.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if row["hi"] is None:
        raise ValueError("no dated sales: cannot resolve the cutoff")
    return row["lo"], row["hi"]


def stock_cutoff(spark: SparkSession, sf_dir: str) -> date:
    """Last day of the shelf feed (= last event day)."""
    value = table(spark, sf_dir, "events").agg(F.max(F.to_date("ts")).alias("hi")).first()["hi"]
    if value is None:
        raise ValueError("no events: cannot resolve the stock cutoff")
    return value


def fx_rows_bound(lo: date, hi: date) -> int:
    """Upper bound of the FX dimension: quoted currencies plus the identity
    rate, per day of the months that the span touches."""
    return (len(QUOTED) + 1) * ((hi - lo).days + 62)


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily USD and EUR quotes (``date, currency, rate``) from the dates of both sales feeds: each
    status of a month's orders and shipped lines quotes a rate whose decimals are its total in cents
    (USD) or its number of rows (EUR), for every day of the month. Statuses write the currency
    differently and disagree on the rate. Like a central-bank feed it publishes nothing on Sundays,
    so a Sunday sale in USD or EUR has no rate (the FX check must see it)."""

    def sold(name: str, day: str, status: str, price: str) -> DataFrame:
        cents = (F.col(price).cast("decimal(18,2)") * 100).cast("long")
        return table(spark, sf_dir, name).select(F.trunc(day, "MM").alias("month"), F.col(status).alias("status"), cents.alias("cents"))

    both = sold("orders", "o_orderdate", "o_orderstatus", "o_totalprice").unionByName(
        sold("lineitem", "l_shipdate", "l_linestatus", "l_extendedprice")
    )
    totals = both.groupBy("month", "status").agg(
        F.pmod(F.sum("cents"), F.lit(100)).alias("USD"), F.pmod(F.count(F.lit(1)), F.lit(100)).alias("EUR")
    )
    written = F.create_map(*[F.lit(x) for kv in QUOTE_TEXT.items() for x in kv])
    text = F.coalesce(written[F.col("status")], F.lit("{}"))
    quotes = F.array(*[
        F.struct(
            F.replace(text, F.lit("{}"), F.lit(c.lower()) if c == "EUR" else F.lit(c)).alias("currency"),
            (F.lit(whole) + F.col(c) / F.lit(100.0)).alias("rate"),
        )
        for c, whole in QUOTED
    ])
    days = F.sequence(F.col("month"), F.last_day("month"), F.expr("interval 1 day"))
    return (
        totals.where(F.col("month").isNotNull())
        .select("month", F.explode(quotes).alias("q"))
        .select(F.explode(days).alias("date"), "q.currency", "q.rate")
        .where(F.dayofweek("date") != 1)  # 1 = Sunday
    )


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ERP catalogue: ``sku_erp, name, category, cost_history`` where the
    history is ``array<struct<valid_from:string, cost:decimal, supplier:string>>``."""
    part = table(spark, sf_dir, "part")
    retail = F.col("p_retailprice").cast("decimal(12,2)")

    def version(i: Column) -> Column:
        factor = (F.lit(20) + i).cast("decimal(4,0)") * F.lit(Decimal("0.1"))
        return F.struct(
            F.date_format(F.date_add(F.lit(COST_HISTORY_START).cast("date"), i * COST_STEP_DAYS), "yyyy-MM-dd").alias("valid_from"),
            (retail * factor).cast("decimal(18,3)").alias("cost"),
            F.concat(F.lit("SUP-"), i.cast("string")).alias("supplier"),
        )

    return part.select(
        ident(ERP_SKU, "p_partkey").alias("sku_erp"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.transform(F.sequence(F.lit(0), F.lit(COST_VERSIONS - 1)), version).alias("cost_history"),
    )


def mappings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official mapping ``sku_pos, sku_erp, handle``. Like a hand-kept table it
    is incomplete and partly wrong: the point-of-sale SKU is empty for sizes 48+,
    the ERP SKU for sizes 1-2, and handles of brand ``Brand#7`` carry the size
    instead of the product number."""
    part = table(spark, sf_dir, "part")
    number = F.when(F.col("p_brand") == "Brand#7", F.col("p_size")).otherwise(F.col("p_partkey"))
    slug = F.lower(F.regexp_replace(F.trim("p_name"), " +", "-"))
    return part.select(
        F.when(F.col("p_size") < 48, ident(POS_SKU, "p_partkey")).alias("sku_pos"),
        F.when(F.col("p_size") > 2, ident(ERP_SKU, "p_partkey")).alias("sku_erp"),
        F.concat(slug, F.lit("-"), zero_pad(number, 3)).alias("handle"),
    )


def stores_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shops (suppliers) and stock points (customers): ``store_id, city, region,
    timezone``."""
    geo = F.broadcast(nation_currency(spark, sf_dir).select("nationkey", "nation", "region"))
    supp = table(spark, sf_dir, "supplier").select(
        ident(STORE_ID, "s_suppkey").alias("store_id"), F.col("s_nationkey").alias("nk")
    )
    cust = table(spark, sf_dir, "customer").select(
        ident(STOCK_POINT_ID, "c_custkey").alias("store_id"), F.col("c_nationkey").alias("nk")
    )
    both = supp.unionByName(cust)
    return both.join(geo, both["nk"] == geo["nationkey"], "left").select(
        "store_id", F.col("nation").alias("city"), "region", F.lit("UTC").alias("timezone")
    )


def shelf_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shelf readings per stock point and product (``date, store_id, sku_erp,
    stock``): every day between the product's first and last event there; 'N/A' on a day
    with an error event, else the number of purchases of that day (0 on a quiet day).
    The product is one of ``SHELF_PRODUCTS`` by the event id. Densified per point and
    product with ``explode(sequence)``, not by a cross join."""
    series = ["user_id", "product"]
    ev = table(spark, sf_dir, "events").select(
        "user_id", (F.pmod("event_id", F.lit(SHELF_PRODUCTS)) + 1).alias("product"), F.to_date("ts").alias("date"), "event_type"
    )
    daily = ev.groupBy(*series, "date").agg(
        F.max((F.col("event_type") == "error").cast("int")).alias("errors"),
        F.sum((F.col("event_type") == "purchase").cast("int")).alias("purchases"),
    )
    span = daily.groupBy(*series).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    grid = span.select(*series, F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    snap = grid.join(daily.hint("merge"), [*series, "date"], "left")
    stock = F.when(F.col("errors") == 1, F.lit("N/A")).otherwise(
        F.coalesce(F.col("purchases"), F.lit(0)).cast("string")
    )
    return snap.select(
        "date",
        ident(STOCK_POINT_ID, "user_id").alias("store_id"),
        ident(ERP_SKU, "product").alias("sku_erp"),
        stock.alias("stock"),
    )


def dispatch_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock counted at each dispatch (``date, store_id, sku_erp, stock``): one
    count per shipped line, 'N/A' where the line carries no tax record.
    Several lines of a product on one day repeat the grain."""
    li = table(spark, sf_dir, "lineitem")
    units = (F.col("l_partkey") * 7 + F.dayofyear("l_shipdate")) % 50
    return li.select(
        F.to_date("l_shipdate").alias("date"),
        ident(STORE_ID, "l_suppkey").alias("store_id"),
        ident(ERP_SKU, "l_partkey").alias("sku_erp"),
        F.when(F.col("l_tax") == 0, F.lit("N/A")).otherwise(units.cast("string")).alias("stock"),
    )


def snapshots_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shelf_snapshots(spark, sf_dir).unionByName(dispatch_snapshots(spark, sf_dir))


# ------------------------------------------------------------------ ERP documents
def snapshot_documents(snapshots: DataFrame) -> DataFrame:
    """A document for each store and month: as many snapshots as products x days."""
    row = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), "store_id", "sku_erp", "stock")
    month = F.trunc("date", "MM").alias("month")
    return snapshots.groupBy("store_id", month).agg(F.collect_list(row).alias("snapshots")).select("snapshots")


def single_documents(rows: DataFrame, name: str) -> DataFrame:
    """A document for each row, with it as the only element of array ``name``."""
    return rows.select(F.array(F.struct(*rows.columns)).alias(name))


def catalog_documents(catalog: DataFrame, size: int = 500) -> DataFrame:
    """A document for each ``block`` of about ``size`` products, by number."""
    block = F.floor(F.regexp_extract("sku_erp", "([0-9]+)", 1).cast("long") / size).alias("block")
    return catalog.groupBy(block).agg(F.collect_list(F.struct(*catalog.columns)).alias("catalog"))


def write_erp_document(arrays: dict[str, DataFrame], path: str) -> None:
    """One document in one file with all rows of each array, as an ERP system exports it. The
    file is written by one task, row after row."""
    spark = next(iter(arrays.values())).sparkSession
    out, sign = spark.createDataFrame([], "part int, at long, value string"), "{"
    for i, (name, rows) in enumerate(arrays.items()):
        head = spark.range(1).select(F.lit(2 * i).alias("part"), F.lit(0).cast("long").alias("at"), F.lit(f'{sign}"{name}": [').alias("value"))
        # numbered in one partition, so that 0 is the first row
        one = rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).coalesce(1).withColumn("at", F.monotonically_increasing_id())
        body = one.select(F.lit(2 * i + 1).alias("part"), "at", F.concat(F.when(F.col("at") == 0, "").otherwise(","), "value").alias("value"))
        out, sign = out.unionByName(head).unionByName(body), "], "
    end = spark.range(1).select(F.lit(2 * len(arrays)).alias("part"), F.lit(0).cast("long").alias("at"), F.lit("]}").alias("value"))
    out.unionByName(end).coalesce(1).sortWithinPartitions("part", "at").select("value").write.text(path)
