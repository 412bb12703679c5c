"""Stock readings: unknown is not zero.

The legacy ERP writes a sentinel text when no count was taken. A sentinel (or
NULL) becomes NULL units with ``reading_valid = false``; it must never turn into
0, which would invent stock-outs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts the ERP uses for "no reading" (compared upper-cased).
STOCK_SENTINELS = ("N/A", "NA", "null", "")

# Integer text, optionally with a decimal part that is dropped ('5.0' -> 5).
_NUMBER = r"^[+-]?[0-9]+(\.[0-9]*)?$"


def parse_stock(col: Column | str, sentinels: Sequence[str] = STOCK_SENTINELS) -> Column:
    """Stock text -> INT units, NULL for sentinels and unreadable text."""
    raw = F.upper(F.trim(F.col(col) if isinstance(col, str) else col))
    whole = F.regexp_extract(raw, r"^([+-]?[0-9]+)", 1)
    return (
        F.when(raw.isNull() | raw.isin([s.upper() for s in sentinels]), F.lit(None).cast("int"))
        .when(raw.rlike(_NUMBER), whole.try_cast("int"))
        .otherwise(F.lit(None).cast("int"))
    )
