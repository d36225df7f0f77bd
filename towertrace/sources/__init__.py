"""Readers: delimited text with a fixed schema, catalog tables, and the
views that adapt the driver's test tables to the event data model."""

from .text import (
    read_checked_text, read_events_text, read_subjects_text, split_valid, read_lines, numbered_lines,
)
from .tables import (
    read_table, register_external_text_table, load_managed_table, ensure_database, list_tables,
)
from .testdata import (
    load, cdr_from_events, subjects_from_events, visits_from_events,
    stays_from_orders, subjects_from_customers,
)

__all__ = [
    "read_checked_text", "read_events_text", "read_subjects_text", "split_valid", "read_lines", "numbered_lines",
    "read_table", "register_external_text_table", "load_managed_table", "ensure_database",
    "list_tables",
    "load", "cdr_from_events", "subjects_from_events", "visits_from_events",
    "stays_from_orders", "subjects_from_customers",
]
