"""The tracing job: events + subjects -> contacts, as one lazy plan.

The pairing rule runs once over all events; the stays are tagged with
whether their phone is a subject and swept once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.contacts import event_cuts, find_contacts
from ..operators.density import PIECES, SPLIT_ROWS
from ..operators.intervals import intervals
from ..schema import DAY_BUCKET
from ..sinks.text import write_sorted_phones, write_table


def trace(events: DataFrame, subjects: DataFrame, rule: str = "robust",
          include: bool = False, bucket_span: int | None = DAY_BUCKET,
          split_rows: int = SPLIT_ROWS, pieces: int = PIECES) -> DataFrame:
    """Distinct contact phones (column `phone`).  Buckets of a tower with more
    than `split_rows` events are swept in `pieces`."""
    return find_contacts(intervals(events, rule, include_phone=True, bucket_span=bucket_span), subjects, include,
                         bucket_span, event_cuts(events, bucket_span, split_rows, pieces), pieces=pieces)


def trace_stays(stays: DataFrame, subjects: DataFrame, include: bool = False,
                bucket_span: int | None = DAY_BUCKET, split_rows: int = SPLIT_ROWS,
                pieces: int = PIECES) -> DataFrame:
    """Contacts from stays that are already intervals."""
    return find_contacts(stays, subjects, include, bucket_span, split_rows=split_rows, pieces=pieces)


def trace_to(events: DataFrame, subjects: DataFrame, table: str, text_path: str,
             rule: str = "robust", include: bool = False,
             bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """The job with its sinks: the contacts replace `table`, and the sorted
    phone list under `text_path` is exported from the written table, so the
    contacts are computed once.  Returns the table."""
    write_table(trace(events, subjects, rule, include, bucket_span), table)
    contacts = events.sparkSession.table(table)
    write_sorted_phones(contacts, text_path)
    return contacts
