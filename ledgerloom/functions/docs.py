"""Signed document types.

Fixed defaults (Mexican e-invoice catalogue): ``I`` income counts +1, ``E``
credit note counts -1; payment complements ``P``, transfers ``T`` and payroll
``N`` are not sales and count 0. Any type in neither list also counts 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Document type lists.
INCOME_TYPES = ("I",)
RETURN_TYPES = ("E",)
EXCLUDED_TYPES = ("P", "T", "N")


def document_sign(
    col: Column | str,
    income: Sequence[str] = INCOME_TYPES,
    returns: Sequence[str] = RETURN_TYPES,
) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (
        F.when(c.isin(list(income)), F.lit(1))
        .when(c.isin(list(returns)), F.lit(-1))
        .otherwise(F.lit(0))
    )


def unknown_document_type(
    col: Column | str,
    income: Sequence[str] = INCOME_TYPES,
    returns: Sequence[str] = RETURN_TYPES,
    excluded: Sequence[str] = EXCLUDED_TYPES,
) -> Column:
    """True for a type that is in none of the three configured lists."""
    c = F.col(col) if isinstance(col, str) else col
    return ~F.coalesce(c.isin(list(income) + list(returns) + list(excluded)), F.lit(False))
