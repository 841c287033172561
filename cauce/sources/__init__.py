from cauce.sources.files import (
    read_clean,
    read_delimited,
    read_dimensions,
    read_html_table,
    read_json_array,
    read_landing,
    read_xml_rows,
)
from cauce.sources.html import html_rows, html_table
from cauce.sources.paged import PagedJson, count_records, read_pages
from cauce.sources.records import (
    land,
    project_fields,
    read_page_files,
    records_from_json,
    unreadable_counts,
)

__all__ = [
    "PagedJson",
    "count_records",
    "html_rows",
    "html_table",
    "land",
    "project_fields",
    "read_clean",
    "read_delimited",
    "read_dimensions",
    "read_html_table",
    "read_json_array",
    "read_landing",
    "read_page_files",
    "read_pages",
    "read_xml_rows",
    "records_from_json",
    "unreadable_counts",
]
