"""Sinks: tables and text exports."""

from .text import merge_parts, recover_table, write_lines, write_sorted_phones, write_table

__all__ = ["merge_parts", "recover_table", "write_lines", "write_sorted_phones", "write_table"]
