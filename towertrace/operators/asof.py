"""As-of join of two tables: to each left row the nearest right row in time.

No row of one side is ever compared with the rows of the other.  Both sides
are united, tagged and shuffled by (keys, time bucket, piece); one window in
time order keeps the last right row it has passed, and one summary row per
piece (its first or last right row) is carried to the pieces beyond it.  A
dense bucket is cut into equi-depth pieces (`density`), so a key that holds a
third of all rows is swept by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DAY_BUCKET
from .density import PIECES, SPLIT_ROWS, dense_cuts, with_pieces
from .intervals import bucket_sql

#: Buckets that rows without a key or a time are spread over.
NO_MATCH = 1024


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str,
              direction: str = "forward", how: str = "left", prefix: str = "next_",
              bucket_span: int | None = DAY_BUCKET, split_rows: int = SPLIT_ROWS,
              pieces: int = PIECES) -> DataFrame:
    """Every left row with the columns of its match, named `prefix` + column:
    the first right row of the same `on` at or after the left row's time
    (`forward`), or the last one at or before it (`backward`).

    Times are whole numbers.  Of right rows at one time the smallest one (by
    its columns in order) matches.  Left rows without a match, with a null key
    or a null time have nulls (`how="left"`) or are left out (`"inner"`);
    right rows with a null key or time match nothing.  Repeated left rows are
    matched each."""
    if direction not in ("forward", "backward") or how not in ("left", "inner"):
        raise ValueError("direction is forward or backward, how is left or inner")
    forward = direction == "forward"
    # at one time the sweep must meet right rows first
    left_kind, right_kind, turn = (0, 1, "DESC") if forward else (1, 0, "ASC")
    keys = [f"_k{i}" for i in range(len(on))]
    named = [f"`{c}` AS {k}" for c, k in zip(on, keys)]
    whole = " AND ".join(f"{k} IS NOT NULL" for k in [*keys, "_key"])
    payload = [c for c in right.columns if c not in on]
    match = "named_struct(" + ", ".join(f"'{c}', `{c}`" for c in payload) + ")"

    r = right.selectExpr(*named, f"CAST(`{right_time}` AS BIGINT) AS _key", f"{right_kind} AS _kind",
                         f"{match} AS _r").where(whole)
    a = left.selectExpr(*named, f"CAST(`{left_time}` AS BIGINT) AS _key", f"{left_kind} AS _kind",
                        "named_struct(" + ", ".join(f"'{c}', `{c}`" for c in left.columns) + ") AS _l")
    rows = a.unionByName(r, allowMissingColumns=True).selectExpr(
        "*", f"IF({whole}, {bucket_sql('_key', bucket_span)}, -1L - pmod(xxhash64(_l), {NO_MATCH})) AS _b")
    cuts = dense_cuts(rows.where(whole).select(*keys, "_b", "_key"), keys, "_key", split_rows, pieces)
    by = [*keys, "_b", "_p"]
    u = with_pieces(rows, cuts, keys, "_kind", 2, ["_l", "_r"], pieces).repartition(*by)

    # the nearest right row inside the piece, and the one to carry out of it;
    # rows of one hot instant may lie in several pieces, so the least of both counts
    part = ", ".join(by)
    found = f"IF(_r IS NULL, NULL, named_struct('t', {'_key' if forward else '-_key'}, 'r', _r))"
    near = u.selectExpr("*", f"last({found}, true) OVER (PARTITION BY {part} ORDER BY _key {turn}, _kind {turn}, _r DESC "
                             "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _m")
    every = f"max(hash({', '.join(u.columns)}))"
    per = u.groupBy(*by).agg(F.expr(f"min({found})").alias("_x"), F.expr(every).alias("_all")).where("_all IS NOT NULL")
    carry = per.selectExpr(
        *by, f"min(_x) OVER (PARTITION BY {', '.join(keys)} ORDER BY _b {turn}, _p {turn} "
             "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _c").withColumnsRenamed({c: f"{c}_" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    out = near.where(f"_kind = {left_kind}").join(carry, same).selectExpr(
        "_l.*", f"IF({whole}, least(_m, _c).r, NULL) AS _m")
    if how == "inner":
        out = out.where("_m IS NOT NULL")
    return out.select(*(F.col(f"`{c}`") for c in left.columns),
                      *(F.col(f"_m.`{c}`").alias(f"{prefix}{c}") for c in payload))
