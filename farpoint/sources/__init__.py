"""Readers (text documents, class records, CSV points) and driver-table shapes."""

from farpoint.sources.files import (
    read_class_records,
    read_points_csv,
    read_text_documents,
    with_file_row_id,
    with_row_index,
)
from farpoint.sources.tables import (
    class_records_from,
    documents_from,
    load_table,
    points_from,
)

__all__ = [
    "read_text_documents", "read_class_records", "read_points_csv", "with_row_index",
    "with_file_row_id",
    "load_table", "class_records_from", "documents_from", "points_from",
]
