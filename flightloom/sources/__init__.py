from flightloom.sources.catalog import inline_rows, scan, scan_periods_of, scan_where_in
from flightloom.sources.csv_files import parsed_line, read_csv, read_lines, write_csv
from flightloom.sources.maximum_table import MaximumTable
from flightloom.sources.tables import (
    append_rows,
    create_table,
    save_bucketed,
    save_lookup_table,
    save_table,
)
from flightloom.sources.topics import FileTopics, KafkaTopics, Topics

__all__ = [
    "FileTopics",
    "KafkaTopics",
    "MaximumTable",
    "Topics",
    "append_rows",
    "create_table",
    "inline_rows",
    "parsed_line",
    "read_csv",
    "read_lines",
    "save_bucketed",
    "save_lookup_table",
    "save_table",
    "scan",
    "scan_periods_of",
    "scan_where_in",
    "write_csv",
]
