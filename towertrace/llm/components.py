"""Connected components by alternating large and small stars.

Each round rewires every node's larger (then smaller) neighbours to the least
node it sees; rounds are logarithmic in number.  Nothing is collected: the
driver reads one row per round, a count and a hash sum, to see whether the
edges still change.  Both inputs of every join are files in the shared
folder, so adaptive execution can split a hub's rows over several tasks, and
a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, drop_cut


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 30))).first()
    return row[0], row[1] or 0


def _least(pairs: DataFrame) -> DataFrame:
    return cut(pairs.groupBy("u").agg(F.min("v").alias("m"))
               .select("u", F.least("u", "m").alias("m")), "star-least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = cut(moved.where("u <> v").distinct(), "star-large")
    drop_cut(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = cut(moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "star-small")
    drop_cut(least)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """`edges (a bigint, b bigint)` -> `(node, component)`, the least node id
    reachable, for every node that has an edge to another one.

    Loops, repeats and either direction are allowed; rows with a null are
    ignored; no edge gives an empty result.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
            "star-edges")
    seen = _state(e)
    while seen[0]:
        large = _large_star(e)
        drop_cut(e)
        e = _small_star(large)
        drop_cut(large)
        now = _state(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select("v", "v").distinct()))
