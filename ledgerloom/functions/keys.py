"""Conformed product key.

Three source systems spell the same product three ways; all three carry the
same running number, which becomes the integer ``product_key``:

    point of sale   CN-00018            -> 18
    ERP             ERP-PROV-MX-018-A   -> 18
    web shop        some-handle-018     -> 18

Text that does not match yields NULL (never an exception, also with ANSI on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The identifier formats of the three source systems.
POS_PATTERN = r"^CN-0*([0-9]+)$"
ERP_PATTERN = r"^ERP-[A-Z]+-[A-Z]+-0*([0-9]+)-[A-Z]$"
HANDLE_PATTERN = r"-0*([0-9]+)$"
POS_PREFIX, POS_WIDTH = "CN-", 5


def _number(col: Column, pattern: str) -> Column:
    digits = F.regexp_extract(F.trim(col), pattern, 1)
    # regexp_extract gives '' for no match and NULL for NULL input
    return F.when(digits != "", digits.try_cast("bigint"))


def key_from_pos(col: Column | str) -> Column:
    """``CN-00018`` (surrounding blanks allowed) -> 18."""
    return _number(F.col(col) if isinstance(col, str) else col, POS_PATTERN)


def key_from_erp(col: Column | str) -> Column:
    """``ERP-PROV-MX-018-A`` -> 18."""
    return _number(F.col(col) if isinstance(col, str) else col, ERP_PATTERN)


def key_from_handle(col: Column | str) -> Column:
    """Trailing number of a web handle: ``mug-ceramic-039`` -> 39."""
    return _number(F.col(col) if isinstance(col, str) else col, HANDLE_PATTERN)


def zero_pad(num: Column | str, width: int) -> Column:
    """Decimal text of an integer, left-padded with zeros to ``width`` (like
    ``%0<width>d``). Wider numbers are kept whole: a bare ``lpad`` would cut them
    and make different keys collide. Cheaper than ``format_string``, which runs a
    ``java.util.Formatter`` per row."""
    n = F.col(num) if isinstance(num, str) else num
    s = n.cast("string")
    return (
        F.when(n < 0, F.format_string(f"%0{width}d", n))
        .when(F.length(s) >= width, s)
        .otherwise(F.lpad(s, width, "0"))
    )


def format_sku(key: Column | str) -> Column:
    """Generated point-of-sale SKU for a key: ``CN-`` + at least 5 digits."""
    return F.concat(F.lit(POS_PREFIX), zero_pad(key, POS_WIDTH))
