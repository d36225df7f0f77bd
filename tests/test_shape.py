"""Time formatting, visit splitting and replication."""

import os

import pytest
from pyspark.sql import functions as F

from towertrace.functions import format_time_of_day
from towertrace.operators.shape import replicate_events, split_visits_to_events


def test_format_time_of_day_clamps(spark):
    df = spark.createDataFrame([("20220507", s) for s in (-5, 0, 59, 3661, 86399, 90000)],
                               "day string, sec int")
    got = [r.t for r in df.select(format_time_of_day("day", "sec").alias("t")).collect()]
    assert got == [20220507000000, 20220507000000, 20220507000059, 20220507010101,
                   20220507235959, 20220507235959]


def test_split_visits(spark):
    v = spark.createDataFrame([(13000000001, 55000000001, "20220507", 60, 120),
                               (13000000002, 55000000001, "20220507", 50, 50)],
                              "phone long, cellid long, day string, enterSec int, exitSec int")
    got = sorted(tuple(r) for r in split_visits_to_events(v).collect())
    assert got == [(55000000001, 20220507000100, 1, 13000000001),
                   (55000000001, 20220507000200, 2, 13000000001)]


def test_replicate(spark):
    ev = spark.createDataFrame([(5, 1, 1, 7)], "cellid long, times long, register int, phone long")
    got = sorted(tuple(r) for r in replicate_events(ev, 3, 100, 10).collect())
    assert got == [(5, 1, 1, 7, 0), (15, 1, 1, 107, 1), (25, 1, 1, 207, 2)]


EVENTS = "/root/testdata/sf0.01/events.parquet"


@pytest.mark.skipif(not os.path.exists(EVENTS), reason="test data not present")
def test_integer_time_key_equals_formatted(spark):
    from towertrace.functions import ts_to_times
    ev = spark.read.parquet(EVENTS)
    diff = ev.where(ts_to_times("ts") != F.date_format("ts", "yyyyMMddHHmmss").cast("long"))
    assert diff.count() == 0
    col = ev.select(ts_to_times(F.col("ts")).alias("a"), ts_to_times("ts").alias("b"))
    assert col.where("a <> b").count() == 0
