"""Events -> stays under the four pairing rules.

Per key (phone, cellid) the events are ordered by (times, register): at
equal times a null code comes first, then the codes by value, so an enter
comes before an exit and a zero-length stay [t, t] survives.

Scale design
------------
None of the rules sorts a whole key in one task.  Each key is cut into
time buckets (`times div bucket_span`); windows run per
(phone, cellid, bucket), which is one hash shuffle of the events and one
sort.  Whatever is complete inside a bucket leaves from there.  What a
bucket needs from its neighbours (the next bucket's first code, the
previous bucket's last row, the stay still open at its start) travels in
one or two summary rows per bucket, which are shuffled by key and ordered
with a window; a key's summary rows are bounded by its time span, not by
its number of events.  `bucket_span=None` puts each key in a single bucket.

Expressions are written as SQL snippets: the plans are the same as with
column objects, and building a query costs far fewer driver round trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DAY_BUCKET, ENTER, EXIT, STAY_COLUMNS

KEY = ["phone", "cellid"]
#: Stands for a null code where nulls are skipped.
NO_CODE = -(1 << 31)
RULES = ("robust", "adjacent", "ordinal", "first_exit")

# window clauses: inside a bucket, and over a key's buckets / pieces
W_LOCAL = "PARTITION BY phone, cellid, _b ORDER BY times, register"
W_BUCKETS = "PARTITION BY phone, cellid ORDER BY _b"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
AFTER = "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"


def bucket_sql(col: str, bucket_span: int | None) -> str:
    """Time bucket of `col` as SQL.  Never null (a null time falls in
    bucket 0), so Spark infers no extra filter on one side of a join of two
    frames derived from the same shuffle, and the shuffle is reused."""
    if bucket_span is None:
        return "CAST(0 AS BIGINT)"
    if int(bucket_span) <= 0:
        raise ValueError("bucket_span must be positive")
    return f"coalesce(`{col}` div {int(bucket_span)}, CAST(0 AS BIGINT))"


def bucket_of(col: str, bucket_span: int | None) -> F.Column:
    return F.expr(bucket_sql(col, bucket_span))


def keyed_events(df: DataFrame, bucket_span: int | None) -> DataFrame:
    """The events, shuffled by key and bucket.  The shuffle is written out so
    that it stands below the rules' own expressions: every rule over the same
    events has the same one, and a plan with two rules reads it twice."""
    return df.selectExpr(
        "CAST(phone AS BIGINT) AS phone", "CAST(cellid AS BIGINT) AS cellid",
        "CAST(times AS BIGINT) AS times", "CAST(register AS INT) AS register",
    ).withColumn("_b", bucket_of("times", bucket_span)).repartition(*KEY, "_b")


def _edges(x: DataFrame, *more: str) -> DataFrame:
    """`_prv` / `_nxt`: the neighbouring codes inside the bucket; `_fst` /
    `_lst`: whether the row is the bucket's first / last one (a neighbour's
    code may be null, so it cannot tell); plus any further window columns."""
    return x.selectExpr("*", f"lag(register) OVER ({W_LOCAL}) AS _prv",
                        f"lead(register) OVER ({W_LOCAL}) AS _nxt",
                        f"row_number() OVER ({W_LOCAL}) = 1 AS _fst",
                        f"lead(1) OVER ({W_LOCAL}) IS NULL AS _lst", *more)


def _at_last(c: str) -> str:
    """Aggregate: value of `c` on the bucket's last row."""
    return f"max(CASE WHEN _lst THEN {c} END)"


def _at_first(c: str) -> str:
    """Aggregate: value of `c` on the bucket's first row."""
    return f"max(CASE WHEN _fst THEN {c} END)"


def _agg(df: DataFrame, keys: list[str], **aggs: str) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.expr(f"{sql} AS {name}") for name, sql in aggs.items()))


def _project(df: DataFrame, include_phone: bool) -> DataFrame:
    cols = STAY_COLUMNS if include_phone else STAY_COLUMNS[1:]
    return df.select(*cols)


# --- robust: state machine with look-ahead -------------------------------

def robust(events: DataFrame, include_phone: bool = True,
           bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """Outside + enter opens at t; inside + enter is ignored; inside + exit
    closes only when it is the key's last row or the next row is an enter,
    giving (first enter, that exit); an exit while outside is ignored; an
    open stay at the end is dropped.

    Equivalent set form: a row *closes* when it is an exit followed by an
    enter (or by nothing).  Closes cut the key into segments; a segment with
    an enter yields (its first enter, its close).

    Plan: inside a bucket the closes seen there cut it into local segments.
    Segments strictly between two such closes are final.  Only the first
    and the last local segment of each bucket (at most two rows per bucket,
    however many events it holds) are gathered per key and stitched across
    buckets with one ordered window: the last segment's close depends on the
    next bucket's first code, and a stay may run over several buckets.
    Final segments ride the same (segment-level) shuffle, grouped by their
    own bucket, so the plan is one straight line: events shuffle, sort and
    windows once; segments shuffle once.
    """
    x = _edges(keyed_events(events, bucket_span))
    x = x.selectExpr("*", f"CAST(register = {EXIT} AND _nxt = {ENTER} AS INT) AS _ic")
    x = x.selectExpr("*", f"coalesce(sum(_ic) OVER ({W_LOCAL} {BEFORE}), 0) AS _cc")

    # local segments (no shuffle: already partitioned by key and bucket)
    seg = _agg(x, [*KEY, "_b", "_cc"],
               _enter=f"min(CASE WHEN register = {ENTER} THEN times END)",
               _close="max(CASE WHEN _ic = 1 THEN times END)",
               _last_t=_at_last("times"), _last_r=_at_last("register"),
               _first_r=_at_first("register"))
    # Interior segments (after a close, ended by a close) are final; they
    # keep their bucket as group key.  The bucket's first and last segment
    # go to the key's group (-1), where they are stitched in time order.
    # One shuffle carries both, so the events are sorted only once.
    seg = seg.selectExpr(
        "*", "CASE WHEN _cc > 0 AND _close IS NOT NULL THEN _b ELSE -1 END AS _gk").where(
        "_gk = -1 OR _enter IS NOT NULL")
    wp = "PARTITION BY phone, cellid, _gk ORDER BY _b, _cc"
    seg = seg.selectExpr("*", f"lead(_first_r, 1, {ENTER}) OVER ({wp}) AS _nf")
    seg = seg.selectExpr(
        "*", "CASE WHEN _gk = -1 THEN coalesce(_close, CASE WHEN _last_r = "
             f"{EXIT} AND _nf = {ENTER} THEN _last_t END) ELSE _close END AS _pc")
    seg = seg.selectExpr(
        "*", f"CASE WHEN _gk = -1 THEN coalesce(count(_pc) OVER ({wp} {BEFORE}), 0) "
             "ELSE _cc END AS _g")
    out = (_agg(seg, [*KEY, "_gk", "_g"], enter_time="min(_enter)", exit_time="max(_pc)")
           .where("enter_time IS NOT NULL AND exit_time IS NOT NULL"))
    return _project(out, include_phone)


# --- adjacent: previous row enter, own row exit --------------------------

def _bucket_edges(x: DataFrame) -> DataFrame:
    """Per (key, bucket): its first row (`_ft`, `_fr`) and the last row of
    the key's previous bucket (`_pt`, `_pr`)."""
    bk = _agg(x, [*KEY, "_b"], _ft=_at_first("times"), _fr=_at_first("register"),
              _lt=_at_last("times"), _lr=_at_last("register"))
    return bk.selectExpr("*", f"lag(_lt) OVER ({W_BUCKETS}) AS _pt",
                         f"lag(_lr) OVER ({W_BUCKETS}) AS _pr")


def with_previous(events: DataFrame, bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """Every event with `prev_register` / `prev_time` of the row before it
    in its key (null for the key's first row)."""
    x = _edges(keyed_events(events, bucket_span), f"lag(times) OVER ({W_LOCAL}) AS _pt")
    inner = x.where("NOT _fst").selectExpr(
        "phone", "cellid", "times", "register", "_prv AS prev_register", "_pt AS prev_time")
    heads = _bucket_edges(x).selectExpr(
        "phone", "cellid", "_ft AS times", "_fr AS register",
        "_pr AS prev_register", "_pt AS prev_time")
    return inner.unionByName(heads)


def adjacent(events: DataFrame, include_phone: bool = True,
             bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """A row is kept when the previous row of its key is an enter and it is
    an exit; stay = (previous time, own time).  Duplicates are kept.

    Pairs inside a bucket are final.  Each bucket's first and last row also
    go to the key's group (-1), where a first row finds the previous
    bucket's last row as its predecessor (first rows order before last rows
    of the same bucket).  One shuffle of pairs and edge rows; the events
    are sorted once."""
    x = _edges(keyed_events(events, bucket_span), f"lag(times) OVER ({W_LOCAL}) AS _pt")
    x = x.where(f"(_prv = {ENTER} AND register = {EXIT}) OR _fst OR _lst")
    x = x.selectExpr("*", "CASE WHEN _fst OR _lst THEN -1 ELSE _b END AS _gk",
                     "CASE WHEN _fst THEN 0 ELSE 1 END AS _ek")
    we = "PARTITION BY phone, cellid, _gk ORDER BY _b, _ek, times, register"
    x = x.selectExpr("*", f"lag(register) OVER ({we}) AS _er", f"lag(times) OVER ({we}) AS _et")
    out = x.selectExpr(
        "phone", "cellid",
        f"CASE WHEN _prv = {ENTER} AND register = {EXIT} THEN _pt "
        f"WHEN _fst AND register = {EXIT} AND _gk = -1 AND _er = {ENTER} THEN _et "
        "END AS enter_time",
        "times AS exit_time").where("enter_time IS NOT NULL")
    return _project(out, include_phone)


# --- ordinal: k-th enter with k-th exit ----------------------------------

def with_ordinal(events: DataFrame, bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """Enter and exit rows with `idx`, their 0-based rank among the key's
    rows of the same code, ordered by time."""
    w = "PARTITION BY phone, cellid, register, _b ORDER BY times"
    x = keyed_events(events, bucket_span).where(f"register IN ({ENTER}, {EXIT})").selectExpr(
        "*", f"row_number() OVER ({w}) - 1 AS _r", "count(1) OVER (PARTITION BY phone, cellid, register, _b) AS _n")
    # one row per bucket, from the same shuffle, gives the rank it starts at
    bk = x.where("_r = 0").selectExpr(
        "phone", "cellid", "register", "_b",
        f"coalesce(sum(_n) OVER (PARTITION BY phone, cellid, register ORDER BY _b {BEFORE}), 0) AS _base")
    return x.join(bk, [*KEY, "register", "_b"]).selectExpr(
        "phone", "cellid", "times", "register", "_base + _r AS idx")


def ordinal(events: DataFrame, include_phone: bool = True,
            bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """Pair the k-th enter with the k-th exit of each key; a stay may end
    before it starts, and unmatched rows are dropped."""
    x = with_ordinal(events, bucket_span)
    # each (key, idx) holds at most one enter and one exit: a hash aggregate
    # pairs them (one shuffle, no sort-merge join)
    out = _agg(x, [*KEY, "idx"],
               enter_time=f"max(CASE WHEN register = {ENTER} THEN times END)",
               exit_time=f"max(CASE WHEN register = {EXIT} THEN times END)")
    return _project(out.where("enter_time IS NOT NULL AND exit_time IS NOT NULL"), include_phone)


# --- first exit: each run-starting enter with the earliest exit at or after it

def first_exit(events: DataFrame, include_phone: bool = True,
               bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """Each enter whose previous row is not an enter is paired with the
    earliest exit of its key whose time is >= its own (peers included).

    Starts whose predecessor and exit are both inside their bucket are
    final.  The others (a bucket's first row, or enters after the bucket's
    last exit) go to the key's group (-1) together with each bucket's last
    row, which carries the bucket's last code and earliest exit; ordered
    range frames over the bucket number then give the previous bucket's
    last code and the earliest exit of later buckets.  One shuffle of
    starts and edge rows; the events are sorted once."""
    x = _edges(keyed_events(events, bucket_span),
               f"min(CASE WHEN register = {EXIT} THEN times END) OVER ("
               "PARTITION BY phone, cellid, _b ORDER BY times "
               "RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _nx")
    x = x.selectExpr("*", f"register = {ENTER} AND NOT (_prv <=> {ENTER}) AS _st")
    # the bucket's earliest exit, known on its last row
    x = x.selectExpr("*", f"CASE WHEN _lst THEN min(CASE WHEN register = {EXIT} "
                          "THEN times END) OVER (PARTITION BY phone, cellid, _b) END AS _bx")
    x = x.where("_st OR _lst")
    # a bucket's last row always joins the key's group: it carries the carry
    x = x.selectExpr(
        "*", "CASE WHEN _lst THEN -1 WHEN NOT _fst AND _nx IS NOT NULL THEN _b ELSE -1 END AS _gk")
    wk = "PARTITION BY phone, cellid, _gk ORDER BY _b"
    x = x.selectExpr(
        "*",
        f"last(CASE WHEN _lst THEN coalesce(register, {NO_CODE}) END, true) OVER ({wk} "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _prev_reg",
        f"min(_bx) OVER ({wk} RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS _later_exit")
    out = x.where(f"_st AND (NOT _fst OR NOT (_prev_reg <=> {ENTER}))").selectExpr(
        "phone", "cellid", "times AS enter_time",
        "CASE WHEN _gk = -1 THEN coalesce(_nx, _later_exit) ELSE _nx END AS exit_time",
    ).where("exit_time IS NOT NULL")
    return _project(out, include_phone)


_RULES = {"robust": robust, "adjacent": adjacent, "ordinal": ordinal, "first_exit": first_exit}


def intervals(events: DataFrame, rule: str = "robust", include_phone: bool = True,
              bucket_span: int | None = DAY_BUCKET) -> DataFrame:
    """Rule selector.  `simple` is accepted as the Spark job's name of the
    adjacent rule."""
    name = {"simple": "adjacent", "first-exit": "first_exit"}.get(rule.lower(), rule.lower())
    if name not in _RULES:
        raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")
    return _RULES[name](events, include_phone=include_phone, bucket_span=bucket_span)
