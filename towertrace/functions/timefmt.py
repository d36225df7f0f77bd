"""Time as an ordered BIGINT `yyyyMMddHHmmss` (compared, never subtracted)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LAST_SECOND_OF_DAY


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def times_sql(ts: str) -> str:
    """SQL text of `ts_to_times` for a column name."""
    return (f"(CAST(year(`{ts}`) AS BIGINT) * 10000000000 + CAST(month(`{ts}`) AS BIGINT) * 100000000"
            f" + CAST(day(`{ts}`) AS BIGINT) * 1000000 + CAST(hour(`{ts}`) AS BIGINT) * 10000"
            f" + CAST(minute(`{ts}`) AS BIGINT) * 100 + CAST(second(`{ts}`) AS BIGINT))")


def ts_to_times(ts) -> Column:
    """Timestamp -> `yyyyMMddHHmmss` as BIGINT (sub-second part dropped).

    Built from integer fields rather than a formatted string: the same value
    as `date_format(ts, 'yyyyMMddHHmmss')` for years 0..9999, without a
    per-row string round trip."""
    if isinstance(ts, str):
        return F.expr(times_sql(ts))
    t = ts
    return (F.year(t).cast("long") * 10_000_000_000 + F.month(t).cast("long") * 100_000_000
            + F.dayofmonth(t).cast("long") * 1_000_000 + F.hour(t).cast("long") * 10_000
            + F.minute(t).cast("long") * 100 + F.second(t).cast("long"))


def seconds_of_day(ts) -> Column:
    """Second of the day of a timestamp, 0..86399."""
    t = _c(ts)
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("int")


def clamp(x, lo: int, hi: int) -> Column:
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


def format_time_of_day(day, sec) -> Column:
    """`day` (string `yyyyMMdd`) + zero-padded `HHmmss` of `sec` clamped to
    0..86399, as BIGINT."""
    s = clamp(sec, 0, LAST_SECOND_OF_DAY)
    hh = F.lpad((s / 3600).cast("int").cast("string"), 2, "0")
    mm = F.lpad(((s % 3600) / 60).cast("int").cast("string"), 2, "0")
    ss = F.lpad((s % 60).cast("string"), 2, "0")
    return F.concat(_c(day), hh, mm, ss).cast("long")
