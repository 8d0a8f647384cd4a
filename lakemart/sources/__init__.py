"""Sources and sinks: CSV feeds, catalog tables, and the test-table feeds."""

from lakemart.sources.catalog import count_sql, create_layers, describe_tables, show_tables, write_table
from lakemart.sources.csv_feed import damaged_lines, read_feed, read_feed_with_damage, write_feed

__all__ = [
    "count_sql",
    "create_layers",
    "damaged_lines",
    "describe_tables",
    "read_feed",
    "read_feed_with_damage",
    "show_tables",
    "write_feed",
    "write_table",
]
