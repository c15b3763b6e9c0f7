"""Readers for landed files and table sinks."""

from panelspark.sources.lines import numbered_lines
from panelspark.sources.publish import publish_table, published_versions, read_published
from panelspark.sources.readers import (CORRUPT, SERIES_SCHEMA, SHEET_COLUMNS, contiguous_year_prefix, corrupt_rows, damaged_sheet_rows,
                                        landed_years, matrix_rows, parse_delimited, parse_series, read_delimited,
                                        read_json_matrix, read_lookup, read_series_ndjson, read_sheet_set,
                                        sheet_rows, string_schema, tag_source)
from panelspark.sources.sinks import write_table

__all__ = [
    "CORRUPT", "SERIES_SCHEMA", "SHEET_COLUMNS", "contiguous_year_prefix", "corrupt_rows", "damaged_sheet_rows", "landed_years",
    "matrix_rows", "numbered_lines", "parse_delimited", "parse_series", "publish_table", "published_versions", "read_delimited", "read_json_matrix", "read_lookup",
    "read_published", "read_series_ndjson", "read_sheet_set", "sheet_rows", "string_schema", "tag_source", "write_table",
]
