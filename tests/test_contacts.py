"""Overlap and contacts: boundary fixtures and strategy agreement."""

import os
import random

import pytest

import pyrules
from pyspark.sql import functions as F
from towertrace.operators import find_contacts, overlap_counts, overlapping_stays, tag_subjects
from towertrace.plans import trace, trace_to

SF = "/root/testdata/sf0.001"
STAY = "phone long, cellid long, enter_time long, exit_time long"


def _stays(spark, rows):
    return spark.createDataFrame(rows, STAY)


def _subjects(spark, phones):
    return spark.createDataFrame([(p,) for p in phones], "phone long")


CASES = [
    ((2, 1, 20, 30), True),    # touching end
    ((3, 1, 0, 10), True),     # touching start
    ((4, 1, 21, 30), False),
    ((5, 1, 0, 9), False),
    ((6, 1, 12, 15), True),    # inside
    ((7, 1, 0, 99), True),     # around
    ((8, 2, 10, 20), False),   # other tower
]


@pytest.mark.parametrize("span", [None, 1, 7])
def test_overlap_boundaries(spark, span):
    subject = (1, 1, 10, 20)
    st = _stays(spark, [subject] + [c for c, _ in CASES])
    subj = _subjects(spark, [1])
    inc = find_contacts(st, subj, include=True, bucket_span=span)
    exc = find_contacts(st, subj, include=False, bucket_span=span)
    want = sorted([1] + [c[0] for c, hit in CASES if hit])
    assert sorted(r.phone for r in inc.collect()) == want
    assert sorted(r.phone for r in exc.collect()) == [p for p in want if p != 1]


def test_second_subject_excluded(spark):
    st = _stays(spark, [(1, 1, 10, 20), (2, 1, 15, 25), (3, 1, 24, 30)])
    subj = _subjects(spark, [1, 2, 2])
    assert sorted(r.phone for r in find_contacts(st, subj, include=True).collect()) == [1, 2, 3]
    assert sorted(r.phone for r in find_contacts(st, subj, include=False).collect()) == [3]


def test_empty_subjects(spark):
    assert find_contacts(_stays(spark, [(1, 1, 10, 20)]), _subjects(spark, []), include=True).count() == 0


@pytest.mark.parametrize("span", [None, 4])
def test_reversed_stay_between_two_subject_stays_is_no_contact(spark, span):
    # no single subject stay holds 15 and 5, though their union does
    st = _stays(spark, [(1, 1, 1, 10), (1, 1, 9, 20), (2, 1, 15, 5)])
    got = find_contacts(st, _subjects(spark, [1]), include=True, bucket_span=span)
    assert [r.phone for r in got.collect()] == [1]


def _random_stays(seed, n=600, towers=4, span=60, neg=False):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        e = rnd.randint(0, span)
        x = e + rnd.randint(0, 8)
        if neg and rnd.random() < 0.2:
            e, x = x, e
        rows.append((rnd.randint(1, 80), rnd.randint(1, towers), e, x))
    return rows


@pytest.mark.parametrize("neg", [False, True])
@pytest.mark.parametrize("span", [None, 1, 5])
def test_sweep_agrees_with_brute_force(spark, neg, span):
    rows = _random_stays(11 + neg, neg=neg)
    subjects = set(range(1, 81, 9))
    st, subj = _stays(spark, rows), _subjects(spark, sorted(subjects))
    for include in (True, False):
        got = sorted(r.phone for r in find_contacts(st, subj, include, span).collect())
        assert got == pyrules.contacts(rows, subjects, include), include
    hit = [a for a in rows if any(s[0] in subjects and s[1] == a[1] and a[2] <= s[3] and a[3] >= s[2] for s in rows)]
    got = [tuple(r)[:4] for r in overlapping_stays(tag_subjects(st, subj), span).collect()]
    assert sorted(got) == sorted(hit)


@pytest.mark.parametrize("span", [None, 3])
def test_overlap_counts_brute_force(spark, span):
    rows = _random_stays(3, n=400)
    subjects = set(range(1, 81, 7))
    st = _stays(spark, rows)
    sub_rows = [r for r in rows if r[0] in subjects]
    got = {(r.phone, r.cellid, r.enter_time, r.exit_time): r.overlaps
           for r in overlap_counts(st, _subjects(spark, sorted(subjects)), bucket_span=span).collect()}
    want = {}
    for a in set(rows):
        n = sum(1 for s in sub_rows if s[1] == a[1] and a[2] <= s[3] and a[3] >= s[2])
        if n:
            want[a] = n
    assert got == want


def test_trace_on_events(spark):
    # subject 1 and phone 2 share tower 5 during [3, 6] / [5, 9]; phone 3 elsewhere
    ev = spark.createDataFrame(
        [(5, 3, 1, 1), (5, 6, 2, 1), (5, 5, 1, 2), (5, 9, 2, 2), (6, 5, 1, 3), (6, 9, 2, 3)],
        "cellid long, times long, register int, phone long")
    subj = _subjects(spark, [1])
    for rule in ("robust", "adjacent", "ordinal", "first_exit"):
        got = sorted(r.phone for r in trace(ev, subj, rule=rule, include=True).collect())
        assert got == [1, 2], rule
        got = sorted(r.phone for r in trace(ev, subj, rule=rule, include=False).collect())
        assert got == [2], rule


def test_same_result_any_partitioning(spark):
    st = _stays(spark, _random_stays(21))
    subj = _subjects(spark, list(range(1, 81, 5)))
    res = []
    for parts in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        res.append(sorted(r.phone for r in find_contacts(st, subj, include=True).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1]


@pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test data not present")
@pytest.mark.parametrize("key,scans,reused", [
    ("contacts_include", 2, 1),   # events and subject list; the stays are shuffled once
    ("reconcile_report", 2, 4),   # both rules read one shuffle of the events
    ("stays_contacts_include", 3, 1),
    ("event_ordinal", 1, 1),
])
def test_plans_share_their_shuffles(spark, key, scans, reused):
    from towertrace.plans.registry import QUERIES
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    # joins by shuffle, as at scale: the stays are counted before they are swept
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == scans
    assert plan.count("ReusedExchange") >= reused
    # the sweep never joins on the tower alone
    assert not [x for x in plan.split("\n") if "Join [cellid" in x and ", _b" not in x.split("]")[0]]


def test_job_writes_table_and_sorted_text(spark, tmp_path):
    ev = spark.createDataFrame(
        [(5, 3, 1, 1), (5, 6, 2, 1), (5, 5, 1, 2), (5, 9, 2, 2), (6, 5, 1, 3), (6, 9, 2, 3)],
        "cellid long, times long, register int, phone long")
    table = trace_to(ev, _subjects(spark, [1]), "job_contacts", str(tmp_path / "out"), include=True)
    assert sorted(r.phone for r in table.collect()) == [1, 2]
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["1", "2"]


def _hot_stays(seed, n=3000, instant=False):
    """One day; one of 30 towers sees a third of the stays, and with `instant`
    most of them enter or leave at one second."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        e = 20220507000000 + rnd.randint(0, 59) * 100 + rnd.randint(0, 59)
        x = e + rnd.choice([0, 1, 5, 30])
        if instant and rnd.random() < 0.7:
            e, x = rnd.choice([(e, max(e, 20220507003000)), (20220507003000, 20220507003000),
                               (min(e, 20220507003000), 20220507003000), (20220507003000, 20220507003010)])
        rows.append((rnd.randint(1, 900), 1 if i % 3 == 0 else rnd.randint(2, 30), e, x))
    return rows


@pytest.mark.parametrize("instant", [False, True])
def test_dense_tower_is_split_and_exact(spark, instant):
    from towertrace.operators import contacts

    rows = _hot_stays(5, instant=instant)
    subjects = set(range(1, 901, 40))
    st, subj = _stays(spark, rows), _subjects(spark, sorted(subjects))
    tagged = tag_subjects(st, subj)
    hit = [a for a in rows if any(s[0] in subjects and s[1] == a[1] and a[2] <= s[3] and a[3] >= s[2]
                                  for s in rows)]
    assert 0 < len(hit) < len(rows)
    got = [tuple(r)[:4] for r in overlapping_stays(tagged, split_rows=150, pieces=16).collect()]
    assert sorted(got) == sorted(hit)
    counts = {tuple(r)[:4]: r.overlaps for r in
              overlap_counts(st, subj, split_rows=150, pieces=16).collect()}
    want = {a: sum(1 for s in rows if s[0] in subjects and s[1] == a[1] and a[2] <= s[3] and a[3] >= s[2]) for a in set(hit)}
    assert counts == want
    # the rows of the hot tower lie in many pieces and tasks, none of them large
    probes = tagged.selectExpr("*", "exit_time AS _key", "1 AS _kind")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        swept = contacts._swept(probes, 1_000_000, "_kind", 2, None, 150, 16)
        per = swept.where("cellid = 1").withColumn("task", F.spark_partition_id()).groupBy("_p").agg(F.count("*").alias("n"), F.min("task").alias("task")).collect()
        others = swept.where("cellid <> 1").agg(F.max("_p")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert others == 0
    assert len({r.task for r in per}) >= 4 and max(r.n for r in per) < 0.35 * sum(r.n for r in per)


def test_trace_splits_by_the_events(spark):
    from towertrace.operators import event_cuts

    rnd = random.Random(9)
    ev = []
    for phone in range(1, 400):
        t = 20220507000000 + rnd.randint(0, 20) * 100
        tower = 1 if phone % 3 == 0 else rnd.randint(2, 20)
        for _ in range(6):
            ev.append((tower, t, rnd.choice([1, 1, 2, 2, 0]), phone))
            t += rnd.randint(0, 40)
    events = spark.createDataFrame(ev, "cellid long, times long, register int, phone long")
    subj = _subjects(spark, list(range(1, 400, 21)))
    cuts = event_cuts(events, split_rows=200, pieces=8).collect()
    assert [(r.cellid, len(r._cuts)) for r in cuts] == [(1, 7)]
    assert list(cuts[0]._cuts) == sorted(cuts[0]._cuts)
    assert event_cuts(events).count() == 0
    for rule in ("robust", "adjacent", "ordinal", "first_exit"):
        whole, split = (sorted(r.phone for r in trace(events, subj, rule, include=True, **kw).collect())
                        for kw in ({}, {"split_rows": 200, "pieces": 8}))
        assert whole == split and whole, rule


def test_pieces_must_be_a_power_of_two(spark):
    from towertrace.operators import event_cuts

    with pytest.raises(ValueError):
        event_cuts(spark.createDataFrame([], "cellid long, times long, register int, phone long"), pieces=12)
