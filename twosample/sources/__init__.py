"""Sources and sinks (A1-A4)."""
from twosample.sources.positions import first_rows, with_positions
from twosample.sources.readers import (column_profile, csv_group, csv_groups, first_column, inline_groups,
                                       inline_json, json_groups, read_csv,
                                       read_table)
from twosample.sources.sinks import as_json, write_results

__all__ = ["column_profile", "csv_group", "csv_groups", "first_column", "first_rows", "inline_groups", "inline_json", "json_groups",
           "read_csv", "read_table", "as_json", "with_positions", "write_results"]
