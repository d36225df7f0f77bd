"""Subjects, overlap and contacts.

A contact is a phone with a stay that overlaps (closed intervals) a
subject's stay on the same tower.  Only *whether* a stay overlaps matters, so
no pair of stays is ever emitted and the two sides are never joined: every
stay carries a flag that says whether its phone is a subject, and one sweep
per (tower, time bucket) keeps the largest subject exit among the stays that
started so far.  A summary row per bucket carries the maximum to later ones.
Dense buckets are swept in equi-depth pieces (`density`).

The test is exact for stays that end before they start as well: stay [e, x]
overlaps a subject stay [se, sx] iff se <= x and sx >= e.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DAY_BUCKET
from .density import PIECES, SPLIT_ROWS, dense_cuts, with_pieces
from .intervals import bucket_sql, keyed_events

PART = "cellid, _b, _p"

BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def subject_events(events: DataFrame, subjects: DataFrame) -> DataFrame:
    """Events of the subject phones; adaptive execution picks the join from
    the measured size of the list."""
    return events.join(subjects.select("phone"), "phone", "left_semi")


def tag_subjects(stays: DataFrame, subjects: DataFrame) -> DataFrame:
    """Stays with `is_subject`: whether the phone is in `subjects`."""
    listed = subjects.select(F.col("phone").alias("_sp")).distinct()
    return (stays.join(listed, F.col("phone") == F.col("_sp"), "left")
            .select(*stays.columns, F.col("_sp").isNotNull().alias("is_subject")))


def event_cuts(events: DataFrame, bucket_span: int | None = DAY_BUCKET, split_rows: int = SPLIT_ROWS,
               pieces: int = PIECES) -> DataFrame:
    """Cuts of the dense (tower, bucket) groups of events.  A stay ends with
    an event of its tower, so no bucket has more stays than events; the counts
    are taken from the shuffle of the events that the pairing rules read."""
    return dense_cuts(keyed_events(events, bucket_span), ["cellid"], "times", split_rows, pieces)


def _swept(rows: DataFrame, bucket_span: int | None, kind: str, kinds: int, cuts: DataFrame | None,
           split_rows: int, pieces: int) -> DataFrame:
    """Sweep rows `_key, _kind, ...` shuffled by (tower, bucket of `_key`,
    piece).  Without `cuts` the rows themselves are counted.

    The shuffle is written out: the bucket summaries are aggregated from the
    same one.  They read every column, or Spark would prune one of the two
    and shuffle the stays twice.
    """
    rows = rows.where("cellid IS NOT NULL").selectExpr("*", f"{bucket_sql('_key', bucket_span)} AS _b")
    if cuts is None:
        cuts = dense_cuts(rows, ["cellid"], "_key", split_rows, pieces)
    return (with_pieces(rows, cuts, ["cellid"], kind, kinds, ["phone", "enter_time", "exit_time"], pieces)
            .repartition("cellid", "_b", "_p"))


def _summaries(swept: DataFrame, **aggs: str) -> DataFrame:
    """Per (tower, bucket, piece) the aggregates over the earlier ones."""
    every = " + ".join(f"count({c})" for c in swept.columns)
    per = swept.groupBy("cellid", "_b", "_p").agg(
        *(F.expr(sql).alias(name) for name, sql in aggs.items()), F.expr(every).alias("_all")).where("_all >= 0")
    w = f"PARTITION BY cellid ORDER BY _b, _p {BEFORE}"
    how = {name: sql[:3] for name, sql in aggs.items()}  # max or sum
    return per.selectExpr("cellid", "_b", "_p", *(f"{how[n]}({n}) OVER ({w}) AS {n}" for n in aggs))


def overlapping_stays(tagged: DataFrame, bucket_span: int | None = DAY_BUCKET, cuts: DataFrame | None = None,
                      split_rows: int = SPLIT_ROWS, pieces: int = PIECES) -> DataFrame:
    """Tagged stays that overlap a subject stay on their tower.

    Each stay is a probe at its exit; a subject's stay is also a start at its
    enter, holding its exit.  At equal times starts come first.  `cuts` are
    those of `event_cuts` with the same `pieces`; without them the stays are
    counted."""
    rows = tagged.selectExpr(
        "cellid", "phone", "enter_time", "exit_time", "is_subject",
        "inline(CASE WHEN is_subject THEN array(named_struct('_key', exit_time, '_kind', 1), "
        "named_struct('_key', enter_time, '_kind', 0)) ELSE array(named_struct('_key', exit_time, '_kind', 1)) END)")
    u = _swept(rows, bucket_span, "_kind", 2, cuts, split_rows, pieces)
    value = "CASE WHEN _kind = 0 THEN exit_time END"
    carry = _summaries(u, _carry=f"max({value})")
    u = u.selectExpr("*", f"max({value}) OVER (PARTITION BY {PART} ORDER BY _key, _kind {SO_FAR}) AS _m")
    return (u.where("_kind = 1").join(carry, ["cellid", "_b", "_p"])
            .where("_m >= enter_time OR _carry >= enter_time")
            .select("phone", "cellid", "enter_time", "exit_time", "is_subject"))


def find_contacts(stays: DataFrame, subjects: DataFrame, include: bool = False,
                  bucket_span: int | None = DAY_BUCKET, cuts: DataFrame | None = None,
                  split_rows: int = SPLIT_ROWS, pieces: int = PIECES) -> DataFrame:
    """Distinct phones with a stay overlapping a subject stay on the same
    tower; with `include=False` without the subjects themselves."""
    hits = overlapping_stays(tag_subjects(stays, subjects), bucket_span, cuts, split_rows, pieces)
    return (hits if include else hits.where("NOT is_subject")).select("phone").distinct()


def overlap_counts(stays: DataFrame, subjects: DataFrame, bucket_span: int | None = DAY_BUCKET,
                   cuts: DataFrame | None = None, split_rows: int = SPLIT_ROWS, pieces: int = PIECES) -> DataFrame:
    """For each distinct stay, the number of subject stays on its tower that
    overlap it (closed intervals), for stays with at least one.  Subject
    stays must not end before they start (true for every rule but ordinal).

    #overlapping = #{se <= x} - #{sx < e}; the second set is contained in
    the first, so both are running counts over one stream per (tower,
    bucket) with per-bucket carries: no pair is formed."""
    # Subject starts (kind 0) and ends (kind 1); probes: the exit counts
    # starts <= x (kind 2), the enter counts ends < e (kind -1).  At equal
    # keys: end-probe(-1) < start(0) < end(1) < exit-probe(2).
    point = "named_struct('_key', {}, '_kind', {})".format
    probes = f"{point('exit_time', 2)}, {point('enter_time', -1)}"
    rows = tag_subjects(stays, subjects).selectExpr(
        "cellid", "phone", "enter_time", "exit_time",
        f"inline(CASE WHEN is_subject THEN array({probes}, {point('enter_time', 0)}, {point('exit_time', 1)}) "
        f"ELSE array({probes}) END)")
    u = _swept(rows, bucket_span, "_kind + 1", 4, cuts, split_rows, pieces)
    starts, ends = ("sum(CASE WHEN _kind = {} THEN 1 ELSE 0 END)".format(k) for k in (0, 1))
    carry = _summaries(u, _cs=starts, _ce=ends)
    w = f"PARTITION BY {PART} ORDER BY _key, _kind {SO_FAR}"
    u = u.selectExpr("*", f"{starts} OVER ({w}) AS _ns", f"{ends} OVER ({w}) AS _ne")
    p = u.where("_kind IN (-1, 2)").join(carry, ["cellid", "_b", "_p"])
    # the two probes of one stay meet again on the stay itself
    res = p.groupBy("phone", "cellid", "enter_time", "exit_time").agg(
        F.expr("max(CASE WHEN _kind = 2 THEN _ns + coalesce(_cs, 0) END)"
               " - max(CASE WHEN _kind = -1 THEN _ne + coalesce(_ce, 0) END) AS overlaps"))
    return res.where("overlaps > 0")
