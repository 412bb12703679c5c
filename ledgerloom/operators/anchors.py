"""Time anchors. Every window is anchored to the data's cutoff date, never to
``current_date()``, so a rerun next year gives the same answer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(cutoff: date, months: int) -> date:
    """First day of a window of ``months`` calendar months that ends with the cutoff's month."""
    first = cutoff.replace(day=1)
    for _ in range(months - 1):
        first = (first - timedelta(days=1)).replace(day=1)
    return first


def quarter_start(cutoff: date) -> date:
    return date(cutoff.year, 3 * ((cutoff.month - 1) // 3) + 1, 1)


def quarter_label(cutoff: date) -> str:
    return f"{cutoff.year}-Q{(cutoff.month - 1) // 3 + 1}"


def month_start_col(cutoff: Column, months: int | Column) -> Column:
    n = months if isinstance(months, Column) else F.lit(months)
    return F.add_months(F.trunc(cutoff, "MM"), -(n - 1))


def quarter_start_col(cutoff: Column) -> Column:
    return F.trunc(cutoff, "quarter")


def quarter_label_col(cutoff: Column) -> Column:
    return F.format_string("%d-Q%d", F.year(cutoff), F.quarter(cutoff))


def cutoff_frame(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One-row frame ``cutoff``: the latest date over all sources. A source with
    no rows contributes NULL and is ignored (``max`` skips NULLs)."""
    parts = [df.agg(F.max(F.to_date(c)).alias("d")) for df, c in sources]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.max("d").alias("cutoff"))


def resolve_cutoff(sources: Sequence[tuple[DataFrame, str]], override: date | None = None) -> date:
    """Cutoff as a driver-side value (one aggregate job, one row back). Literal
    window bounds then reach the Parquet scans as pushed filters."""
    if override is not None:
        return override
    value = cutoff_frame(sources).first()["cutoff"]
    if value is None:
        raise ValueError("no dated rows in any source: cannot resolve a cutoff")
    return value
