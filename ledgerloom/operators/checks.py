"""Data checks that turn silent errors into loud failures.

Each check is one row (``REPORT_COLUMNS``) computed by Spark; all checks of one
table come from one aggregate over one scan of it. A report unions them; the gate
keeps failed ``error`` rows and ``enforce`` raises on them (the report is bounded:
one row per check).

Thresholds compare counts (``failed * 100 <= limit * total``), never a rounded
percentage, so one bad row in millions still fails a limit of 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.docs import unknown_document_type
from ..functions.money import ratio
from ..sources.footers import footer_bounds
from .keys import mapping_flags

ERROR = "error"
WARNING = "warning"

# Default thresholds in percent.
MAX_PCT_ORPHAN_SALES = 0.5
MAX_PCT_INVALID_READINGS = 5.0
MAX_PCT_MISSING_FX = 0.0

REPORT_COLUMNS = ["check", "severity", "ok", "failed", "total", "pct", "limit_pct", "detail"]


class Check(NamedTuple):
    """A rule: rows for which ``bad`` holds may be ``limit`` percent of all. ``bad`` as a text names
    a key: rows are bad whose key is not in its dimension."""

    name: str
    severity: str
    bad: Column | str
    limit: float
    what: str


def _evaluate(df: DataFrame, checks: Sequence[Check], dimensions: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All checks of one table from one scan: a row for each. With ``dimensions`` (by key) rows are counted
    by their keys first: a key meets its dimension once, however many rows have it (the online
    store has half of all sales). Dimensions grow with the data: merged, not broadcast."""
    failed = {f"_{i}": c.bad for i, c in enumerate(checks)}
    names = ["total", *(n for n, bad in failed.items() if isinstance(bad, Column))]
    counts = [F.count(F.lit(1)), *(F.count_if(F.coalesce(failed[n], F.lit(False))) for n in names[1:])]
    keys = list(dimensions or {})
    sums = df.groupBy(*keys).agg(*(c.alias(n) for n, c in zip(names, counts, strict=True)))
    for i, key in enumerate(keys, 1):
        known = dimensions[key].select(key, F.lit(True).alias("_known")).distinct().hint("merge")
        orphans = [n for n, bad in failed.items() if isinstance(bad, str) and bad == key]
        lost = F.when(F.col("_known").isNull(), F.col("total")).otherwise(0)
        met = sums.join(known, key, "left").withColumns({n: lost for n in orphans})
        names += orphans
        sums = met.groupBy(*keys[i:]).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    return _report(sums, checks)


def _report(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The rows of checks from one row of counts: ``total``, and ``_i`` failures of the i-th check."""
    rows = F.array(*[
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.severity).alias("severity"),
            F.col(f"_{i}").alias("failed"),
            F.lit(c.limit).cast("double").alias("limit_pct"),
            F.lit(c.what).alias("what"),
        )
        for i, c in enumerate(checks)
    ])
    limit = F.col("limit_pct").cast("decimal(9,4)")
    return counts.select("total", F.explode(rows).alias("c")).select("c.*", "total").select(
        "check",
        "severity",
        (F.col("failed") * 100 <= limit * F.col("total")).alias("ok"),
        "failed",
        "total",
        F.coalesce(ratio(F.col("failed") * 100, F.col("total"), 4), F.lit(0.0)).alias("pct"),
        "limit_pct",
        F.concat_ws(" ", "failed", F.lit("of"), "total", "what").alias("detail"),
    )


def check_mapping(mappings: DataFrame) -> DataFrame:
    """The numeric key never contradicts the official mapping table."""
    what = "mapping rows contradict the derived key"
    return _evaluate(mapping_flags(mappings), [Check("mapping_consistent", ERROR, F.col("discrepant"), 0.0, what)])


def _cost_check() -> Check:
    uncovered = F.col("is_revenue") & F.col("product_key").isNotNull() & F.col("cost").isNull()
    return Check("cost_covered", WARNING, uncovered, 0.0, "lines have no cost on their day")


def sales_checks(
    sales: DataFrame,
    products: DataFrame,
    max_pct_orphans: float = MAX_PCT_ORPHAN_SALES,
    max_pct_missing_fx: float = MAX_PCT_MISSING_FX,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Orphan lines (NULL key or key not in the catalogue), lines without a
    converted amount, and lines whose units and amount have opposite signs, in
    one scan of the sales fact; with ``stores`` also lines whose store is not
    in the store dimension, and if the fact is costed lines without a cost."""
    opposite = F.signum("units") * F.signum(F.col("amount").cast("double")) < 0
    checks = [
        Check("sales_have_product", ERROR, "product_key", max_pct_orphans, "lines have no catalogue product"),
        Check("amounts_converted", ERROR, F.col("amount").isNull(), max_pct_missing_fx, "lines have no rate"),
        Check("sign_coherent", ERROR, opposite, 0.0, "lines have units and amount of opposite sign"),
    ]
    dimensions = {"product_key": products}
    if stores is not None:
        dimensions["store_id"] = stores
        checks.append(_store_check())
    if "cost" in sales.columns:
        checks.append(_cost_check())
    return _evaluate(sales, checks, dimensions)


def _store_check() -> Check:
    return Check("sales_have_store", ERROR, "store_id", 0.0, "lines have no known store")


def check_sales_have_store(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Lines whose store is not in the store dimension (marts inner-join the
    store, so such lines would silently vanish from them)."""
    return _evaluate(sales, [_store_check()], {"store_id": stores})


def check_document_types(raw: DataFrame, col: str = "doc_type") -> DataFrame:
    """Raw documents of a type in none of the configured lists (they count 0
    in revenue, which may hide a new source type). Warning by default."""
    what = "documents have an unknown type"
    return _evaluate(raw, [Check("document_types_known", WARNING, unknown_document_type(col), 0.0, what)])


def check_cost_covered(costed: DataFrame) -> DataFrame:
    """Lines with revenue and a product but no cost version valid on their date
    (kept by the as-of join with NULL cost; they add revenue and no cost)."""
    return _evaluate(costed, [_cost_check()])


def inventory_checks(
    inventory: DataFrame, max_pct_invalid: float = MAX_PCT_INVALID_READINGS,
    invalid_severity: str = WARNING,
) -> DataFrame:
    """Share of unknown readings (warning by default) and negative stock, one scan."""
    return _evaluate(inventory, _stock_checks(max_pct_invalid, invalid_severity))


def _stock_checks(max_pct_invalid: float, invalid_severity: str) -> list[Check]:
    return [
        Check("readings_valid", invalid_severity, ~F.col("reading_valid"), max_pct_invalid, "readings are unknown"),
        Check("stock_not_negative", ERROR, F.col("units") < 0, 0.0, "readings are below zero"),
    ]


def inventory_checks_from_footers(
    spark: SparkSession, path: str, max_pct_invalid: float = MAX_PCT_INVALID_READINGS,
    invalid_severity: str = WARNING,
) -> DataFrame:
    """``inventory_checks`` of a stored inventory: a reading is unknown where its units are null, which
    footers count, and no stock is negative where their least is not. Rows are read only to
    count negative ones once there are some."""
    total, bounds = footer_bounds(spark, path, ["units"])
    units = bounds["units"]
    negative = 0
    if units.least is not None and units.least < 0:
        negative = spark.read.parquet(path).where(F.col("units") < 0).count()
    counts = spark.createDataFrame([(total, units.nulls, negative)], "total long, _0 long, _1 long")
    return _report(counts, _stock_checks(max_pct_invalid, invalid_severity))


def check_grain_unique(readings: DataFrame, grain: Sequence[str] = ("date", "store_id", "product_key")) -> DataFrame:
    """Run on the readings *before* deduplication: number of grain keys that
    occur more than once, out of all distinct grain keys."""
    per_key = readings.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"))
    return _evaluate(per_key, [Check("grain_unique", ERROR, F.col("_n") > 1, 0.0, "grain keys repeat")])


def check_revenue_positive(growth: DataFrame) -> DataFrame:
    what = "channel-months have no revenue"
    return _evaluate(growth, [Check("monthly_revenue_positive", ERROR, F.col("revenue") <= 0, 0.0, what)])


def check_turnover_valid(top: DataFrame) -> DataFrame:
    bad = F.col("turnover").isNull() | (F.col("turnover") <= 0)
    return _evaluate(top, [Check("turnover_valid", ERROR, bad, 0.0, "products have no turnover")])


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def quality_report(checks: Sequence[DataFrame], cutoff: date | None = None) -> DataFrame:
    out = _union([c.select(REPORT_COLUMNS) for c in checks])
    return out.withColumn("cutoff", F.lit(cutoff).cast("date"))


def quality_gate(report: DataFrame) -> DataFrame:
    """Rows that stop a run: failed checks of severity ``error``."""
    return report.where(~F.col("ok") & (F.col("severity") == ERROR))


class QualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> list:
    """Raise if any ``error`` check failed; returns the (small) report rows."""
    rows = report.collect()
    failed = [r for r in rows if not r["ok"] and r["severity"] == ERROR]
    if failed:
        lines = "\n".join(f"  - {r['check']}: {r['failed']} of {r['total']}" for r in failed)
        raise QualityError(f"data checks failed:\n{lines}")
    return rows
