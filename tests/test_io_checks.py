"""Ingest, text round trips, line checks and reconciliation."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from towertrace.operators import checks
from towertrace.sinks import write_lines, write_sorted_phones
from towertrace.sources import numbered_lines, read_events_text, read_subjects_text


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_ingest_quarantine(spark):
    tmp = tempfile.mkdtemp(prefix="tt-ingest-")
    _write(tmp, "a.txt", "\n".join([
        "55000000001,20220507000001,1,13000000001",   # good
        "55000000001,bad,2,13000000001",              # bad number
        "",                                           # blank: skipped by the reader
        "5,6",                                        # short
        "1,2,1,3,4",                                  # long: extra field dropped
        " 1,2,1,3",                                   # padded number
        "1,2,1,99999999999999999999",                 # over 64 bits
    ]) + "\n")
    good, bad = read_events_text(spark, tmp, with_quarantine=True)
    assert sorted(tuple(r) for r in good.collect()) == [
        (1, 2, 1, 3), (55000000001, 20220507000001, 1, 13000000001)]
    assert bad.count() == 4


def test_subject_scan(spark):
    tmp = tempfile.mkdtemp(prefix="tt-subj-")
    _write(tmp, "infected.txt", "13000000001\n13000000002\nx\n")
    good, bad = read_subjects_text(spark, tmp, with_quarantine=True)
    assert sorted(r.phone for r in good.collect()) == [13000000001, 13000000002]
    assert bad.count() == 1


def test_numbered_lines_across_files(spark):
    tmp = tempfile.mkdtemp(prefix="tt-lines-")
    _write(tmp, "part-00000", "5\n6\n7\n")
    _write(tmp, "part-00001", "8\n")
    _write(tmp, "part-00002", "9\n10\n")
    got = [(r.line_no, r.line) for r in numbered_lines(spark, tmp).orderBy("line_no").collect()]
    assert got == [(1, "5"), (2, "6"), (3, "7"), (4, "8"), (5, "9"), (6, "10")]


def test_lint_fixtures(spark):
    tmp = tempfile.mkdtemp(prefix="tt-lint-")
    _write(tmp, "redmark.txt", "\n".join(["100", "1a0", "200 300", "", "150", "150", "400"]) + "\n")
    nl = numbered_lines(spark, tmp)
    bad = sorted((r.line_no, r.line) for r in checks.bad_lines(nl).collect())
    assert bad == [(2, "1a0"), (3, "200 300"), (4, "")]
    # bad lines are passed over: 100, 150, 150, 400 ascend
    assert checks.order_violations(nl).count() == 0
    dup = [(r.line, r.n) for r in checks.duplicate_values(nl.select("line"), ["line"]).collect()]
    assert dup == [("150", 2)]


def test_descending_pair(spark):
    tmp = tempfile.mkdtemp(prefix="tt-desc-")
    _write(tmp, "a.txt", "1\n3\n2\n2\n10\n9\n")
    nl = numbered_lines(spark, tmp)
    viol = sorted((r.line_no, r.prev_line, r.line) for r in checks.order_violations(nl).collect())
    assert viol == [(3, "3", "2"), (6, "10", "9")]


def test_descending_pair_across_bad_lines_and_files(spark):
    tmp = tempfile.mkdtemp(prefix="tt-desc-")
    _write(tmp, "a.txt", "5\nx\n3\n")
    _write(tmp, "b.txt", "bad\n")
    _write(tmp, "c.txt", "y\n1\n2\n")
    viol = sorted((r.line_no, r.prev_line, r.line) for r in checks.order_violations(numbered_lines(spark, tmp)).collect())
    assert viol == [(3, "5", "3"), (6, "3", "1")]


def test_order_check_on_clean_list(spark):
    tmp = tempfile.mkdtemp(prefix="tt-clean-")
    _write(tmp, "a.txt", "1\n2\n2\n3\n")
    nl = numbered_lines(spark, tmp)
    assert checks.order_violations(nl).count() == 0
    assert checks.bad_lines(nl).count() == 0


def test_sorted_text_sink_round_trip(spark):
    tmp = tempfile.mkdtemp(prefix="tt-sink-")
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5003).alias("phone"))
    path = write_sorted_phones(df, os.path.join(tmp, "out"))
    nl = numbered_lines(spark, path)
    got = [int(r.line) for r in nl.orderBy("line_no").collect()]
    assert got == sorted(got) and len(got) == 5000
    assert checks.order_violations(nl).count() == 0
    one = write_lines(df.orderBy("phone"), os.path.join(tmp, "one"), single_file=True)
    assert len([f for f in os.listdir(one) if f.startswith("part-")]) == 1


def test_reconcile_report(spark):
    e = spark.createDataFrame([(1,), (2,), (3,)], "phone long")
    a = spark.createDataFrame([(2,), (3,), (3,), (4,)], "phone long")
    rep = {r.metric: r.value for r in checks.reconcile_report(e, a).collect()}
    assert rep == {"expected_count": 3, "actual_count": 4, "missing_in_actual": 1,
                   "extra_in_actual": 1, "duplicate_groups_in_actual": 1}


def test_catalog_tables(spark):
    from towertrace.sources import (
        ensure_database, list_tables, load_managed_table, register_external_text_table,
    )
    tmp = tempfile.mkdtemp(prefix="tt-ext-")
    _write(tmp, "part-00000", "55000000001,20220507000001,1,13000000001\n"
                              "55000000001,x,7,13000000001\n"
                              "55000000001,20220507000101,2,13000000001\n")
    ensure_database(spark, "tracing")
    ensure_database(spark, "tracing")  # idempotent, drops nothing
    ext = register_external_text_table(spark, "tracing.cdinfo", tmp)
    _, bad = register_external_text_table(spark, "tracing.cdinfo", tmp, with_quarantine=True)
    assert bad.count() == 1
    other = tempfile.mkdtemp(prefix="tt-ext-")
    _write(other, "part-00000", "1,2,1,3\n")
    with pytest.raises(ValueError):
        register_external_text_table(spark, "tracing.cdinfo", other)
    assert register_external_text_table(spark, "tracing.cdinfo", other, replace=True).count() == 1
    ext = register_external_text_table(spark, "tracing.cdinfo", tmp, replace=True)
    assert ext.count() == 2 and ext.columns == ["cellid", "times", "register", "phone"]
    subj = spark.createDataFrame([(13000000001,)], "phone long")
    load_managed_table(spark, "tracing.infected", subj)
    load_managed_table(spark, "tracing.infected", subj)  # overwrite, not append
    assert spark.table("tracing.infected").count() == 1
    assert list_tables(spark, "tracing") == ["cdinfo", "infected"]


def test_failed_write_keeps_the_table(spark):
    from pyspark.errors import PySparkException

    from towertrace.sinks import write_table
    good = spark.range(5).withColumnRenamed("id", "phone")
    write_table(good, "tt_replace")
    broken = spark.range(5).selectExpr("IF(id = 3, CAST(raise_error('broken') AS BIGINT), id) AS phone")
    with pytest.raises(PySparkException):
        write_table(broken, "tt_replace")
    assert sorted(r.phone for r in spark.table("tt_replace").collect()) == [0, 1, 2, 3, 4]
    # from its own rows, with another schema
    write_table(spark.table("tt_replace").selectExpr("phone * 2 AS phone", "1 AS n"), "tt_replace")
    assert sorted((r.phone, r.n) for r in spark.table("tt_replace").collect()) == [(2 * i, 1) for i in range(5)]
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("tt_replace")]
    assert names == ["tt_replace"]


def test_job_lost_between_the_renames(spark):
    from towertrace.sinks import recover_table, write_table
    spark.sql("CREATE DATABASE IF NOT EXISTS tt_swap")
    write_table(spark.range(3), "tt_swap.phones")
    spark.sql("ALTER TABLE tt_swap.phones RENAME TO tt_swap.phones__replaced_0")
    assert recover_table(spark, "tt_swap.phones") and not recover_table(spark, "tt_swap.phones")
    assert spark.table("tt_swap.phones").count() == 3
    spark.sql("ALTER TABLE tt_swap.phones RENAME TO tt_swap.phones__replaced_0")
    write_table(spark.range(4), "tt_swap.phones")  # the next write clears up by itself
    assert spark.table("tt_swap.phones").count() == 4
    assert [t.name for t in spark.catalog.listTables("tt_swap")] == ["phones"]
    assert not recover_table(spark, "no_such_database.phones")


def test_merged_file_is_the_concatenation(spark):
    from towertrace.sinks import merge_parts
    tmp = tempfile.mkdtemp(prefix="tt-merge-")
    df = spark.range(0, 3000, 1, 7).selectExpr("(id * 7919) % 3001 AS phone")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = write_sorted_phones(df, os.path.join(tmp, "parts"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted(f for f in os.listdir(parts) if f.startswith("part-"))
    assert len(names) > 1
    want = b"".join(open(os.path.join(parts, f), "rb").read() for f in names)
    one = merge_parts(spark, parts, os.path.join(tmp, "out", "all.txt"))
    assert open(one, "rb").read() == want and not os.path.exists(parts)
    single = write_sorted_phones(df, os.path.join(tmp, "single"), single_file=True)
    single = write_sorted_phones(df, os.path.join(tmp, "single"), single_file=True)  # overwrites
    held = [f for f in os.listdir(single) if f.startswith("part-")]
    assert len(held) == 1 and open(os.path.join(single, held[0]), "rb").read() == want
    assert sorted(os.listdir(tmp)) == ["out", "single"]
    empty = write_lines(df.limit(0).selectExpr("CAST(phone AS STRING)"), os.path.join(tmp, "none"), single_file=True)
    assert [os.path.getsize(os.path.join(empty, f)) for f in os.listdir(empty) if f.startswith("part-")] == [0]


def test_bad_lines_with_text_and_place(spark):
    from towertrace.sources import read_checked_text
    tmp = tempfile.mkdtemp(prefix="tt-bad ")
    lines = {"a.txt": ["1,2,1,3", "1,bad,2,3", "", "5,6", "1,2,1,3,4"], "b.txt": [" 1,2,1,3", "4,5,2,6", ",1,2,3", "1,2,1,99999999999999999999", "x"]}
    for name, some in lines.items():
        _write(tmp, name, "\n".join(some) + "\n")
    good, bad = read_checked_text(spark, tmp)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2, 1, 3), (4, 5, 2, 6)]
    got = sorted((r.line_no, os.path.basename(r.file), r.file_line, r.line) for r in bad.collect())
    every = [(f, i, x) for f in sorted(lines) for i, x in enumerate(lines[f], 1)]
    assert got == [(n, *row) for n, row in enumerate(every, 1) if row[2] not in ("1,2,1,3", "4,5,2,6")]


def test_id_range_runs_nothing_while_planned(spark):
    from towertrace.sources.testdata import RANGE_CHUNK, id_range
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("tt-range", "range")
    frame = id_range(spark.createDataFrame([(RANGE_CHUNK - 3,), (None,), (3 * RANGE_CHUNK + 5,)], "phone long"), "phone")
    assert list(tracker.getJobIdsForGroup("tt-range")) == []
    row = frame.agg(F.min("phone"), F.max("phone"), F.count("*"), F.count_distinct("phone")).first()
    size = 2 * RANGE_CHUNK + 9
    assert tuple(row) == (RANGE_CHUNK - 3, 3 * RANGE_CHUNK + 5, size, size)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.phone for r in id_range(spark.createDataFrame([(-2,), (1,)], "phone long"), "phone").orderBy("phone").collect()] == [-2, -1, 0, 1]
    assert id_range(spark.createDataFrame([], "phone long"), "phone").count() == 0
