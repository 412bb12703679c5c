"""Column-level helpers. Every function returns a pyspark ``Column`` built from
built-in expressions, so it stays inside whole-stage codegen."""

from .docs import document_sign
from .keys import format_sku, key_from_erp, key_from_handle, key_from_pos
from .money import MONEY, RATE, UNIT_COST, money_out, ratio, round_half_up, to_money
from .readings import parse_stock

__all__ = [
    "MONEY",
    "RATE",
    "UNIT_COST",
    "document_sign",
    "format_sku",
    "key_from_erp",
    "key_from_handle",
    "key_from_pos",
    "money_out",
    "parse_stock",
    "ratio",
    "round_half_up",
    "to_money",
]
