from tallyspark.sources.fixtures import (
    document_lines,
    documents,
    events_to_items,
    items,
    lineitem_edges,
    raw_edges,
)
from tallyspark.sources.tables import read_table

__all__ = [
    "document_lines", "documents", "events_to_items", "items",
    "lineitem_edges", "raw_edges", "read_table",
]
