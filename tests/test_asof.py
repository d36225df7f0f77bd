"""As-of join of two tables against a search of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from towertrace.operators import asof_join

LEFT, RIGHT = "k long, g string, t long, x int", "k long, g string, t long, v int, x string"


def _rows(seed, n, hot=0.4, span=200, instant=None):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = 1 if rnd.random() < hot else rnd.randint(2, 9)
        t = instant if instant is not None and rnd.random() < 0.5 else rnd.randint(0, span)
        out.append((k if rnd.random() > 0.03 else None, rnd.choice("ab"), t if rnd.random() > 0.03 else None, rnd.randint(0, 3)))
    return out


def _plain(left, right, forward, how):
    out = []
    for k, g, t, x in left:
        fits = [r for r in right if None not in (k, t, r[0], r[2]) and r[:2] == (k, g) and (r[2] >= t if forward else r[2] <= t)]
        best = min(fits, key=lambda r: (r[2] if forward else -r[2], r[3], r[4]), default=None)
        if best or how == "left":
            out.append((k, g, t, x, *(best[2:] if best else (None,) * 3)))
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("span,split,instant", [(None, 1 << 20, None), (7, 1 << 20, None), (50, 40, None), (None, 30, 90)])
def test_against_all_rows(spark, direction, span, split, instant):
    left = _rows(1, 400, instant=instant)
    right = [(*r, "w" + str(r[3])) for r in _rows(2, 250, instant=instant)]
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    for how in ("left", "inner"):
        got = asof_join(a, b, ["k", "g"], "t", "t", direction, how, "m_", span, split, pieces=8)
        assert got.columns == ["k", "g", "t", "x", "m_t", "m_v", "m_x"]
        assert _sorted(map(tuple, got.collect())) == _sorted(_plain(left, right, direction == "forward", how))


def test_dense_key_spreads_over_tasks(spark):
    from towertrace.operators import asof

    left = spark.range(4000).selectExpr("1L AS k", "id AS t")
    right = spark.range(1000).selectExpr("1L AS k", "id * 4 AS t", "id AS v")
    seen = []
    keep = asof.with_pieces
    try:
        asof.with_pieces = lambda *a, **b: seen.append(keep(*a, **b)) or seen[-1]
        got = asof_join(left, right, ["k"], "t", "t", split_rows=500, pieces=16)
    finally:
        asof.with_pieces = keep
    assert got.where("next_t <> ceil(t / 4) * 4 OR (next_t IS NULL AND t <= 3996)").count() == 0
    per = [r.n for r in seen[0].groupBy("_p").agg(F.count("*").alias("n")).collect()]
    assert len(per) >= 12 and max(per) < 1000


def test_empty_sides_and_arguments(spark):
    a = spark.createDataFrame([(1, "a", 5, 0)], LEFT)
    none = spark.createDataFrame([], RIGHT)
    assert [tuple(r) for r in asof_join(a, none, ["k", "g"], "t", "t").collect()] == [(1, "a", 5, 0, None, None, None)]
    assert asof_join(a, none, ["k", "g"], "t", "t", how="inner").count() == 0
    assert asof_join(a.limit(0), none, ["k", "g"], "t", "t").count() == 0
    with pytest.raises(ValueError):
        asof_join(a, none, ["k", "g"], "t", "t", direction="sideways")


def test_plan_joins_no_rows_of_two_sides(spark):
    a, b = spark.createDataFrame([(1, "a", 5, 0)], LEFT), spark.createDataFrame([(1, "a", 6, 0, "z")], RIGHT)
    plan = asof_join(a, b, ["k", "g"], "t", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    for line in plan.split("\n"):
        if "Join Inner" in line or "Join LeftOuter" in line:
            assert "_b" in line  # by key and time bucket, never by the key alone
