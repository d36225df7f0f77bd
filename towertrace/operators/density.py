"""Splitting of dense (key, time bucket) groups into equi-depth pieces.

A sweep sorts the rows of one key and time bucket in one task.  Where a
bucket is dense (a tower that sees a third of a day's stays), its rows are cut
by time into `pieces` of about equal size: a count per bucket names the dense
ones, a quantile sketch of their times (`percentile_approx`, merged from the
tasks' partial sketches) gives the cuts, and the sweep carries its state from
piece to piece as it does from bucket to bucket.

What is broadcast has a proven size: at most `MOST_DENSE` buckets, the densest
ones, of `pieces` - 1 times each.  With n rows in all, a bucket beyond them
holds less than n / MOST_DENSE rows, so the share of rows that one task sorts
is bounded.  Where no bucket is dense, adaptive execution sees the empty count
and drops the sketch and the join.

A single instant may be hot as well.  Its cuts are then equal, and its rows
are dealt over the pieces between them, kind after kind, so that (piece, time,
kind) orders the rows like (time, kind).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT_ROWS = 1 << 20
PIECES = 256
MOST_DENSE = 2048


def _every(df: DataFrame) -> str:
    """An aggregate that reads every column, so that Spark prunes none of them
    below a shuffle that another branch of the plan reads as well."""
    return f"max(hash({', '.join(df.columns)}))"


def dense_cuts(points: DataFrame, keys: list[str], time: str = "_key", split_rows: int = SPLIT_ROWS,
               pieces: int = PIECES) -> DataFrame:
    """`(*keys, _b, _cuts)` for the groups of `keys` and the time bucket `_b`
    with more than `split_rows` points: `pieces` - 1 times that cut them into
    parts of equal size.  `pieces` is a power of two."""
    if pieces < 2 or pieces & (pieces - 1):
        raise ValueError("pieces must be a power of two")
    by, every = [*keys, "_b"], _every(points)
    counted = points.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.expr(every).alias("_all"))
    dense = (counted.where(f"_n > {int(split_rows)} AND _all IS NOT NULL").orderBy(F.desc("_n"), *by)
             .limit(MOST_DENSE).select(*by))
    shares = f"array({', '.join(f'{i / pieces!r}D' for i in range(1, pieces))})"
    cut = points.join(F.broadcast(dense), by).groupBy(*by).agg(
        F.expr(f"percentile_approx(`{time}`, {shares}, {40 * pieces})").alias("_cuts"), F.expr(every).alias("_all"))
    return cut.where("_all IS NOT NULL").select(*by, "_cuts")


def _before(steps: str, less: str) -> str:
    """Binary search: how many of the cuts are `less` than the row's time."""
    return f"aggregate(array({steps}), 0, (p, s) -> IF(element_at(_cuts, p + s) {less} _key, p + s, p))"


def with_pieces(rows: DataFrame, cuts: DataFrame, keys: list[str], kind: str, kinds: int,
                salt: list[str], pieces: int = PIECES) -> DataFrame:
    """`rows` with `_p`, the piece of their time `_key` (0 where the bucket is
    not dense).  `kind` is an expression for 0 .. `kinds` - 1, the order of
    rows at one time; rows of one time and kind may be dealt by `salt`."""
    steps = ", ".join(str(pieces >> k) for k in range(1, pieces.bit_length()))
    out = rows.join(F.broadcast(cuts), [*keys, "_b"], "left").selectExpr(
        *rows.columns, f"IF(_cuts IS NULL, 0, {_before(steps, '<')}) AS _lo",
        f"IF(_cuts IS NULL, 0, {_before(steps, '<=')}) AS _hi")
    first, last = (f"(({kind}) + {k}) * (_hi - _lo) div {kinds}" for k in (0, 1))
    dealt = f"IF(_hi = _lo, 0L, {first} + pmod(xxhash64({', '.join(salt)}), {last} - ({first}) + 1))"
    return out.selectExpr(*rows.columns, f"CAST(_lo + {dealt} AS INT) AS _p")
