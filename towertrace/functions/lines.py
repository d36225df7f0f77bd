"""Text line builders for the export formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def csv_line(cellid="cellid", times="times", register="register", phone="phone") -> Column:
    """`cellid,times,register,phone` (the event file layout)."""
    return F.concat_ws(",", *(as_text(c) for c in (cellid, times, register, phone)))


def rowkey(cellid="cellid", times="times", phone="phone", register="register") -> Column:
    """Row key `cellid_times_phone_register`."""
    return F.concat_ws("_", *(as_text(c) for c in (cellid, times, phone, register)))


def rowkey_tsv_line(cellid="cellid", times="times", register="register", phone="phone") -> Column:
    """Key-value load line: row key, then the four columns, tab separated."""
    return F.concat_ws("\t", rowkey(cellid, times, phone, register),
                       *(as_text(c) for c in (cellid, times, register, phone)))


def subject_tsv_line(phone="phone") -> Column:
    """`phone<TAB>phone`."""
    return F.concat_ws("\t", as_text(phone), as_text(phone))
