"""Column-level helpers; all built-in Spark expressions (codegen-friendly)."""

from .timefmt import ts_to_times, seconds_of_day, format_time_of_day, clamp
from .lines import csv_line, rowkey, rowkey_tsv_line, subject_tsv_line, as_text

__all__ = [
    "ts_to_times", "seconds_of_day", "format_time_of_day", "clamp",
    "csv_line", "rowkey", "rowkey_tsv_line", "subject_tsv_line", "as_text",
]
