"""Sources and sinks: strict CSV, projected Parquet, nested JSON, lake tables."""

from .files import (
    assert_nonempty,
    assert_required,
    explode_array,
    read_csv_strict,
    read_nested_json,
    read_parquet_projected,
    read_sorting_out,
    stamp_lineage,
)
from .feeds import FeedPaths, read_erp_documents, read_feeds, read_fx_csv, read_sales_csv
from .ranges import read_document_arrays
from .lake import clear_scratch, export_csv, read_table, scratch_path, write_table

__all__ = [
    "FeedPaths",
    "assert_nonempty",
    "assert_required",
    "clear_scratch",
    "explode_array",
    "export_csv",
    "read_csv_strict",
    "read_document_arrays",
    "read_erp_documents",
    "read_feeds",
    "read_fx_csv",
    "read_nested_json",
    "read_parquet_projected",
    "read_sales_csv",
    "read_sorting_out",
    "read_table",
    "scratch_path",
    "stamp_lineage",
    "write_table",
]
