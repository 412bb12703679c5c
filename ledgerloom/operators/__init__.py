"""DataFrame -> DataFrame operators (no driver collect, no UDF)."""

from . import anchors, asof, checks, common, dimensions, facts, islands, keys, marts

__all__ = ["anchors", "asof", "checks", "common", "dimensions", "facts", "islands", "keys", "marts"]
