"""Sources: Parquet tables, raw text lines, positional splits, schemas."""

from arearisk.sources.tables import TABLES, load_table, register_tables, table_path  # noqa: F401
from arearisk.sources.text import (  # noqa: F401
    conform, drop_header_lines, empty_strings, drop_marker_lines, field, read_lines, read_lines_drop_header,
    read_lines_drop_marker, read_quoted_csv, sample_rows, split_array, split_fields,
)
