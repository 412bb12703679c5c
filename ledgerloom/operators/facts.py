"""Conformed facts: signed, currency-converted sales of both channels; daily
stock readings that keep "unknown" apart from "zero"; as-of costing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.docs import INCOME_TYPES, RETURN_TYPES, document_sign
from ..functions.keys import key_from_erp, key_from_handle, key_from_pos
from ..functions.money import MONEY, RATE
from ..functions.readings import STOCK_SENTINELS, parse_stock
from .asof import asof_join
from .common import as_date, as_timestamp, broadcast_if_small, keep_first
from .dimensions import ONLINE_STORE, REPORT_CURRENCY

SALES_COLUMNS = [
    "doc_id",
    "channel",
    "date",
    "local_ts",
    "store_id",
    "product_key",
    "doc_type",
    "is_revenue",
    "units",
    "amount",
    "currency",
    "amount_src",
]

READING_COLUMNS = ["date", "store_id", "product_key", "units", "reading_valid"]

# Raw point-of-sale columns, in the order used to pick the surviving duplicate.
POS_RAW = ["doc_id", "ts", "store_id", "sku", "units", "amount", "currency", "doc_type"]
# Raw web-order columns.
ONLINE_RAW = ["order_id", "ts", "handle", "units", "amount", "currency"]


def attach_rate(
    df: DataFrame,
    fx: DataFrame,
    date_col: str,
    ccy_col: str,
    missing_rate: str = "null",
    fx_rows: int | None = None,
    report_currency: str = REPORT_CURRENCY,
) -> DataFrame:
    """Rate of the day of the document (left join on date x currency). An amount in the
    report currency needs no quote: its rate is 1 on any day.
    ``missing_rate``: ``"null"`` leaves the converted amount NULL (caught by the
    FX check); ``"identity"`` applies 1.0. The rate table grows with the calendar,
    not with the facts; it is broadcast when its proven bound ``fx_rows`` is small
    enough, else the planner decides."""
    rates = fx.select(
        F.col("date").alias("_fx_date"),
        F.col("currency").alias("_fx_ccy"),
        F.col("rate").alias("_rate"),
    )
    if fx_rows is not None:
        rates = broadcast_if_small(rates, fx_rows)
    out = df.join(
        rates, (df[date_col] == rates["_fx_date"]) & (df[ccy_col] == rates["_fx_ccy"]), "left"
    ).drop("_fx_date", "_fx_ccy")
    same = F.when(F.col(ccy_col) == report_currency, F.lit(1).cast(RATE))
    out = out.withColumn("_rate", F.coalesce(same, F.col("_rate")))
    if missing_rate == "identity":
        out = out.withColumn("_rate", F.coalesce("_rate", F.lit(1).cast(RATE)))
    elif missing_rate != "null":
        raise ValueError("missing_rate must be 'null' or 'identity'")
    return out


def dedup_documents(raw: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """A re-sent document counts once; the survivor is the first in the order of
    ``columns`` (deterministic, unlike ``dropDuplicates``)."""
    return keep_first(raw.select(*columns), [key], order=[c for c in columns if c != key])


def sales_fact_pos(
    raw: DataFrame,
    fx: DataFrame,
    income: Sequence[str] = INCOME_TYPES,
    returns: Sequence[str] = RETURN_TYPES,
    missing_rate: str = "null",
    fx_rows: int | None = None,
    survivors: bool = False,
) -> DataFrame:
    """Point-of-sale lines: key, sign, report-currency amount. Documents that are
    not sales stay in the fact with 0 units / amount and ``is_revenue = false``.
    ``survivors``: each document is there once already (as ``dedup_documents`` leaves them)."""
    base = raw.select(*POS_RAW) if survivors else dedup_documents(raw, "doc_id", POS_RAW)
    base = base.select(
        "doc_id",
        as_timestamp(base, "ts").alias("local_ts"),
        "store_id",
        key_from_pos("sku").alias("product_key"),
        "doc_type",
        document_sign("doc_type", income, returns).alias("_sign"),
        F.col("units").cast("int").alias("_units"),
        F.col("amount").cast(MONEY).alias("_amount"),
        F.upper(F.trim("currency")).alias("currency"),
    ).withColumn("date", F.to_date("local_ts"))
    j = attach_rate(base, fx, "date", "currency", missing_rate, fx_rows)
    signed = (F.col("_sign") * F.col("_amount")).cast(MONEY)
    return j.select(
        "doc_id",
        F.lit("physical").alias("channel"),
        "date",
        "local_ts",
        "store_id",
        "product_key",
        "doc_type",
        (F.col("_sign") != 0).alias("is_revenue"),
        (F.col("_sign") * F.col("_units")).alias("units"),
        (signed * F.col("_rate")).cast(MONEY).alias("amount"),
        "currency",
        signed.alias("amount_src"),
    )


def sales_fact_online(
    raw: DataFrame,
    fx: DataFrame,
    store_id: str = ONLINE_STORE,
    doc_type: str = "WEB",
    missing_rate: str = "null",
    fx_rows: int | None = None,
    survivors: bool = False,
) -> DataFrame:
    """Web orders: key from the handle, FX of the order day (a missing rate
    leaves the amount NULL), the synthetic online store, always revenue.
    ``survivors`` as for the point of sale."""
    base = raw.select(*ONLINE_RAW) if survivors else dedup_documents(raw, "order_id", ONLINE_RAW)
    base = base.select(
        F.col("order_id").alias("doc_id"),
        as_timestamp(base, "ts").alias("local_ts"),
        key_from_handle("handle").alias("product_key"),
        F.col("units").cast("int").alias("units"),
        F.col("amount").cast(MONEY).alias("amount_src"),
        F.upper(F.trim("currency")).alias("currency"),
    ).withColumn("date", F.to_date("local_ts"))
    j = attach_rate(base, fx, "date", "currency", missing_rate, fx_rows)
    return j.select(
        "doc_id",
        F.lit("online").alias("channel"),
        "date",
        "local_ts",
        F.lit(store_id).alias("store_id"),
        "product_key",
        F.lit(doc_type).alias("doc_type"),
        F.lit(True).alias("is_revenue"),
        "units",
        (F.col("amount_src") * F.col("_rate")).cast(MONEY).alias("amount"),
        "currency",
        "amount_src",
    )


def unify_sales(*facts: DataFrame) -> DataFrame:
    """Column-aligned union of the channel facts (no shuffle)."""
    out = facts[0].select(SALES_COLUMNS)
    for f in facts[1:]:
        out = out.unionByName(f.select(SALES_COLUMNS))
    return out


def inventory_readings(
    snapshots: DataFrame, sentinels: Sequence[str] = STOCK_SENTINELS
) -> DataFrame:
    """Raw snapshots (date, store_id, sku_erp, stock text) -> typed readings,
    before the grain is made unique (the grain check runs on this frame)."""
    units = parse_stock("stock", sentinels)
    return snapshots.select(
        as_date(snapshots, "date").alias("date"),
        "store_id",
        key_from_erp("sku_erp").alias("product_key"),
        units.alias("units"),
        units.isNotNull().alias("reading_valid"),
    )


def inventory_daily(
    snapshots: DataFrame, sentinels: Sequence[str] = STOCK_SENTINELS
) -> DataFrame:
    """One reading per date x store x product of raw snapshots."""
    return settle_readings(inventory_readings(snapshots, sentinels))


def settle_readings(readings: DataFrame) -> DataFrame:
    """One of the readings per date x store x product; a valid reading wins over an
    unknown one, then the smaller count."""
    r = readings.withColumn("_unknown", ~F.col("reading_valid"))
    grain = ["date", "store_id", "product_key"]
    return keep_first(r, grain, order=["_unknown", "units"]).select(READING_COLUMNS)


def value_inventory(
    inventory: DataFrame, cost: DataFrame, drop_uncovered: bool = False, salt: int = 1, strategy: str = "range",
    salted_by: str | None = None,
) -> DataFrame:
    """Cost valid on the reading date x units (NULL units stay NULL value)."""
    j = asof_join(
        inventory, cost, "product_key", "date", ["cost"], drop_uncovered=drop_uncovered, salt=salt, strategy=strategy,
        salted_by=salted_by,
    )
    return j.withColumn("value", (F.col("units") * F.col("cost")).cast(MONEY))


def cost_sales(
    sales: DataFrame, cost: DataFrame, drop_uncovered: bool = False, salt: int = 1, strategy: str = "range",
    salted_by: str | None = None,
) -> DataFrame:
    """Cost valid on the sale date; cost total = units x cost; margin = amount -
    cost total. A sale without a covering cost keeps its row with NULL cost.
    ``salt`` > 1 spreads hot products explicitly; ``strategy="window"`` avoids
    fact x version pairs for dense histories; ``salted_by`` names the salt of facts that are
    stored by product and salt (see ``asof_join``)."""
    j = asof_join(
        sales, cost, "product_key", "date", ["cost"], drop_uncovered=drop_uncovered, salt=salt, strategy=strategy,
        salted_by=salted_by,
    )
    cost_total = (F.col("units") * F.col("cost")).cast(MONEY)
    return j.withColumn("cost_total", cost_total).withColumn(
        "margin", (F.col("amount") - cost_total).cast(MONEY)
    )
