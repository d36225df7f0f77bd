"""Prefix sums over numbered rows as a tree of bounded windows.

A running sum over all rows needs one task that sees them all.  Here the rows
are cut into groups of `FANOUT` neighbours: a window inside each group, the
groups' totals (one row each) summed the same way a level higher, and a join
that adds the two.  The top level has a row per `FANOUT` rows of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FANOUT = 4096
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
#: No row number reaches it: the top level is one group, by a computed key.
TOP = (1 << 63) - 1


def exclusive_scan(rows: DataFrame, order: str, fanout: int = FANOUT, **columns: str) -> DataFrame:
    """`(order, before_<column> ...)`: for each row the sum or the largest of
    a column over all rows with a smaller `order` (null if there is none).

    `order` is a unique whole number, `columns` maps a column to `sum` or
    `max` (values of any ordered type)."""
    if set(columns.values()) - {"sum", "max"}:
        raise ValueError("columns are summed or their largest value is taken")
    rows = rows.select(F.col(order).cast("bigint").alias("_o"), *columns)

    def within(df, group):
        w = f"PARTITION BY _g ORDER BY _o {BEFORE}"
        return df.selectExpr("*", f"_o div {group} AS _g").selectExpr(
            "_o", "_g", *(f"{how}({c}) OVER ({w}) AS before_{c}" for c, how in columns.items()))

    low = within(rows, fanout)
    totals = rows.groupBy(F.expr(f"_o div {fanout} AS _o")).agg(
        *(F.expr(f"{how}({c})").alias(c) for c, how in columns.items()))
    high = within(totals, TOP).selectExpr("_o AS _g", *(f"before_{c} AS above_{c}" for c in columns))
    both = {"sum": "IF(before_{0} IS NULL, above_{0}, before_{0} + coalesce(above_{0}, 0))",
            "max": "greatest(before_{0}, above_{0})"}
    return low.join(high, "_g").selectExpr(
        f"_o AS {order}", *(f"{both[how].format(c)} AS before_{c}" for c, how in columns.items()))
