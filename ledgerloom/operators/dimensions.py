"""Conformed dimensions: store, product, cost history (SCD2), FX, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.keys import format_sku, key_from_erp, key_from_pos
from ..functions.money import RATE, UNIT_COST
from .common import as_date, keep_first

# Open end of a validity interval; the synthetic online store.
OPEN_END = "9999-12-31"
ONLINE_STORE = "ONLINE"
ONLINE_STORE_ATTRS = ("N/A", "digital", "America/Mexico_City")
REPORT_CURRENCY = "MXN"

STORE_COLUMNS = ["store_id", "city", "region", "timezone"]


def dim_store(stores: DataFrame, online_id: str = ONLINE_STORE) -> DataFrame:
    """One row per shop id, and a row ``online_id`` that stands for web sales: every
    sale then joins to exactly one store, whatever its channel."""
    physical = keep_first(stores.select(*STORE_COLUMNS), ["store_id"]).withColumn(
        "channel", F.lit("physical")
    )
    schema = StructType([StructField(c, StringType()) for c in STORE_COLUMNS + ["channel"]])
    online = stores.sparkSession.createDataFrame(
        [(online_id, *ONLINE_STORE_ATTRS, "online")], schema
    )
    return physical.unionByName(online)


def dim_product(catalog: DataFrame, mappings: DataFrame) -> DataFrame:
    """The ERP catalogue is the product universe. Aliases of the other systems
    attach by the derived key (not through the incomplete official mapping),
    and a product without an alias gets a generated point-of-sale SKU."""
    products = keep_first(
        catalog.select(
            key_from_erp("sku_erp").alias("product_key"), "sku_erp", "name", "category"
        ).where(F.col("product_key").isNotNull()),
        ["product_key"],
    )
    aliases = keep_first(
        mappings.select(
            key_from_pos("sku_pos").alias("product_key"),
            F.col("sku_pos").alias("sku_pos_mapped"),
            "handle",
        ).where(F.col("product_key").isNotNull()),
        ["product_key"],
    )
    # both sides are dealt by the key already; unhinted, the planner would broadcast the aliases of any catalogue
    return (
        products.join(aliases.hint("merge"), "product_key", "left")
        .select(
            "product_key",
            "sku_erp",
            F.coalesce("sku_pos_mapped", format_sku("product_key")).alias("sku_pos"),
            "handle",
            "name",
            "category",
            F.col("sku_pos_mapped").isNotNull().alias("has_explicit_mapping"),
        )
    )


def close_intervals(
    changes: DataFrame,
    key: str = "product_key",
    start: str = "valid_from",
    end: str = "valid_to",
    open_end: str = OPEN_END,
) -> DataFrame:
    """SCD2: each version is valid until the day before the next change of the
    same key; the last one stays open. Changes on the same start date are
    reduced to one first, so intervals never overlap and are never empty.
    The window is per key: its size is the number of versions of one key."""
    versions = keep_first(changes, [key, start])
    nxt = F.lead(start).over(Window.partitionBy(key).orderBy(start))
    return versions.withColumn(
        end, F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit(open_end)))
    )


def cost_dimension(catalog: DataFrame, history: str = "cost_history") -> DataFrame:
    """Explode the nested cost history of each catalogue product and close the
    intervals: ``product_key, valid_from, cost, supplier, valid_to``. Products are dealt by key
    before their histories are exploded, so that no later step moves the versions and
    a catalogue of one small file is not exploded by one task."""
    products = catalog.select(key_from_erp("sku_erp").alias("product_key"), F.col(history).alias("history"))
    flat = products.repartition("product_key").select("product_key", F.explode("history").alias("c"))
    vf = F.col("c.valid_from")
    if isinstance(flat.schema["c"].dataType["valid_from"].dataType, StringType):
        vf = F.try_to_date(vf)
    return close_intervals(
        flat.select(
            "product_key",
            vf.alias("valid_from"),
            F.col("c.cost").cast(UNIT_COST).alias("cost"),
            F.col("c.supplier").alias("supplier"),
        )
    )


def fx_dimension(fx: DataFrame, report_currency: str = REPORT_CURRENCY) -> DataFrame:
    """``date, currency, rate``: the smallest quote of each currency and day, by its
    trimmed upper-case code, and the rate 1 of the report currency on each day that some
    currency is quoted."""
    rates = keep_first(
        fx.select(
            as_date(fx, "date").alias("date"),
            F.upper(F.trim("currency")).alias("currency"),
            F.col("rate").cast(RATE).alias("rate"),
        ).where(F.col("currency") != report_currency),
        ["date", "currency"],
    )
    identity = rates.select("date").distinct().select(
        "date", F.lit(report_currency).alias("currency"), F.lit(1).cast(RATE).alias("rate")
    )
    return rates.unionByName(identity)


def calendar(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Continuous days between the bounds of each row of ``bounds`` (inclusive)
    with year, ``yyyy-MM`` and ``yyyy-Qn`` labels."""
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.date_format("date", "yyyy-MM").alias("month"),
        F.concat(F.year("date"), F.lit("-Q"), F.quarter("date")).alias("quarter"),
    )
