"""Reshaping and scale-up of event data (the generator's table operators).

Everything is deterministic row arithmetic, so a recomputed partition after
a lost executor yields the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import format_time_of_day
from ..schema import ENTER, EXIT

def split_visits_to_events(visits: DataFrame) -> DataFrame:
    """Each visit (phone, cellid, day, enterSec, exitSec) -> an enter and an
    exit event (cellid, times, register, phone); empty visits are dropped."""
    v = visits.where(F.col("enterSec") < F.col("exitSec"))
    ev = F.explode(F.array(
        F.struct(format_time_of_day("day", "enterSec").alias("times"), F.lit(ENTER).alias("register")),
        F.struct(format_time_of_day("day", "exitSec").alias("times"), F.lit(EXIT).alias("register")),
    )).alias("_e")
    return v.select("cellid", "phone", ev).select(
        "cellid", F.col("_e.times").alias("times"), F.col("_e.register").cast("int").alias("register"),
        "phone")


def replicate_events(events: DataFrame, copies: int, phone_stride: int, cell_stride: int) -> DataFrame:
    """`copies` copies of the events; copy c shifts phones by c*phone_stride
    and towers by c*cell_stride.  A generator per row, no join."""
    if copies < 1:
        raise ValueError("copies must be >= 1")
    c = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    x = events.select("*", c)
    return x.select(
        (F.col("cellid") + F.col("copy").cast("long") * F.lit(cell_stride)).alias("cellid"),
        "times", "register",
        (F.col("phone") + F.col("copy").cast("long") * F.lit(phone_stride)).alias("phone"),
        F.col("copy").cast("int").alias("copy"),
    )


def union_visits(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def event_summary(visits: DataFrame, planted: DataFrame) -> DataFrame:
    """One row of tallies of two visit tables, from one aggregate over both."""
    u = (visits.select("phone", F.lit(0).alias("_k"))
         .unionByName(planted.select("phone", F.lit(1).alias("_k"))))
    n_v = F.count(F.when(F.col("_k") == 0, F.lit(1)))
    n_p = F.count(F.when(F.col("_k") == 1, F.lit(1)))
    return u.agg(
        n_v.alias("normal_visits"),
        n_p.alias("planted_visits"),
        F.countDistinct(F.when(F.col("_k") == 1, F.col("phone"))).alias("planted_phones"),
        ((n_v + n_p) * 2).alias("event_rows"),
    )
