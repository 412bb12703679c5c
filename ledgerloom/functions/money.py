"""Money and ratio helpers.

Money is carried as DECIMAL end to end: sums are then exact and independent of
the order in which partitions are combined, so two engines (or two runs with a
different partitioning) agree to the last digit. It becomes DOUBLE only on
output, after a half-up rounding to cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,8)"  # amounts in source or report currency
RATE = "decimal(9,4)"  # exchange rate to the report currency
UNIT_COST = "decimal(18,3)"  # unit cost in the report currency


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_money(col: Column | str) -> Column:
    return _c(col).cast(MONEY)


def money_out(col: Column | str, digits: int = 2) -> Column:
    """Half-up (away from zero) decimal rounding, then DOUBLE."""
    return F.round(_c(col), digits).cast("double")


def round_half_up(col: Column | str, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on a DOUBLE; identical IEEE steps in any engine."""
    scale = float(10**digits)
    return F.floor(_c(col).cast("double") * scale + 0.5) / scale


def ratio(num: Column | str, den: Column | str, digits: int | None = None) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (ANSI-safe)."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return r if digits is None else round_half_up(r, digits)
