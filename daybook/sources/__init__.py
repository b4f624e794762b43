"""Readers for line items and for the published daily statistics."""

from daybook.sources.line_items import (
    line_items_from_csv,
    line_items_from_csv_by_header,
    line_items_from_table,
    line_items_from_tpch,
    normalise_line_items,
    read_table,
)

__all__ = [
    "line_items_from_csv",
    "line_items_from_csv_by_header",
    "line_items_from_table",
    "line_items_from_tpch",
    "normalise_line_items",
    "read_table",
]
