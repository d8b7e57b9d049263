from tidewell.sources.files import (
    file_rows, list_files, read_csv, read_json, read_lake, read_projected, rows_read, split_rejects,
)
from tidewell.sources.jdbc import key_quantiles, key_range, read_query, read_table, write_table
from tidewell.sources.local import rows_from_list
from tidewell.sources.typed_text import (
    parse_typed_lines, read_header, read_typed_text, typed_schema,
)

__all__ = [
    "file_rows", "key_quantiles", "key_range", "list_files", "parse_typed_lines", "read_csv", "read_header", "read_json",
    "read_lake", "read_projected", "read_query", "read_table", "read_typed_text",
    "rows_from_list", "rows_read", "split_rejects", "typed_schema", "write_table",
]
