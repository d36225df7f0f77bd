"""Output checks and reconciliation.

Line checks work on numbered lines (see `sources.text.numbered_lines`);
they never put all lines in one task: each check is a filter, a grouped
count, or a lag inside a split plus one edge row per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import exclusive_scan

# A valid list line is one field of digits (surrounding blanks
# and tabs allowed, as in an awk field split).
DIGITS_LINE = r"^[ \t]*[0-9]+[ \t]*$"


def bad_lines(numbered: DataFrame) -> DataFrame:
    """Lines that are not exactly one all-digit field: (line_no, line)."""
    return numbered.where(~F.coalesce(F.col("line").rlike(DIGITS_LINE), F.lit(False))).select(
        "line_no", "line")


def order_violations(numbered: DataFrame) -> DataFrame:
    """Numeric lines that are smaller than the numeric line before them, with
    bad lines in between passed over (ties allowed): (line_no, prev_line,
    line).  Bad lines are reported by `bad_lines`.

    `numbered` comes from `numbered_lines`: inside a split a window finds the
    numeric line before; a split's first numeric line finds it among the
    earlier splits' last ones, carried over by `exclusive_scan`.  No line is
    shuffled but to its own split, and no window spans all splits."""
    value = F.trim(F.col("line")).try_cast("decimal(38,0)")
    rows = numbered.select("split", "line_no", "line", value.alias("_v")).where("_v IS NOT NULL")
    w = "PARTITION BY split ORDER BY line_no"
    rows = rows.selectExpr("*", f"lag(line) OVER ({w}) AS _pl", f"lag(_v) OVER ({w}) AS _pv",
                           f"lead(line_no) OVER ({w}) IS NULL AS _last")
    inner = rows.where("_v < _pv").select("line_no", F.col("_pl").alias("prev_line"), "line")
    firsts = rows.where("_pv IS NULL").select("split", "line_no", "line", "_v")
    lasts = rows.where("_last").selectExpr("split", "named_struct('s', split, 'v', _v, 'line', line) AS _x")
    carried = exclusive_scan(lasts, "split", _x="max").where("before__x IS NOT NULL")
    across = firsts.join(carried, "split").where("_v < before__x.v").select(
        "line_no", F.col("before__x.line").alias("prev_line"), "line")
    return inner.unionByName(across)


def duplicate_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Values of `cols` that occur more than once, with their count `n`."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_groups(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: number of groups of `cols` with more than one row."""
    return duplicate_values(df, cols).agg(F.count(F.lit(1)).alias("duplicate_groups"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """(table, rows) for each named frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing(expected: DataFrame, actual: DataFrame, key: str = "phone") -> DataFrame:
    """Rows of `expected` whose key is absent from `actual`."""
    return expected.select(key).join(actual.select(key), key, "left_anti")


def reconcile_report(expected: DataFrame, actual: DataFrame, key: str = "phone") -> DataFrame:
    """(metric, value): counts, missing, extra and duplicate key groups.

    One full outer join of the per-key counts of both sides feeds one
    aggregate, so each side is computed once however many metrics use it."""
    e = expected.groupBy(key).agg(F.count(F.lit(1)).alias("_ne"))
    a = actual.groupBy(key).agg(F.count(F.lit(1)).alias("_na"))
    r = e.join(a, key, "full_outer").agg(
        F.expr("coalesce(sum(_ne), 0) AS expected_count"),
        F.expr("coalesce(sum(_na), 0) AS actual_count"),
        F.expr("count(CASE WHEN _na IS NULL THEN 1 END) AS missing_in_actual"),
        F.expr("count(CASE WHEN _ne IS NULL THEN 1 END) AS extra_in_actual"),
        F.expr("count(CASE WHEN _na > 1 THEN 1 END) AS duplicate_groups_in_actual"),
    )
    names = ["expected_count", "actual_count", "missing_in_actual", "extra_in_actual",
             "duplicate_groups_in_actual"]
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return r.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, value)")
