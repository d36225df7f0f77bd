"""A user's rule over streamed, sorted groups."""

import random
import resource

import pyarrow as pa
import pytest

import pyrules
from towertrace.operators import apply_sorted, robust
from towertrace.operators.groups import robust_rule

EVENTS = "cellid long, times long, register int, phone long"
STAYS = "phone bigint, cellid bigint, enter_time bigint, exit_time bigint"


def _events(seed, n=2000):
    rnd = random.Random(seed)
    return [(rnd.randint(1, 4), rnd.randint(0, 300), rnd.choice([1, 1, 2, 2, 0, None]), 1 if rnd.random() < .4 else rnd.randint(2, 40))
            for _ in range(n)]


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_robust_rule_gives_the_robust_stays(spark, batch):
    """Also when a group goes over many batches."""
    events = spark.createDataFrame(_events(4), EVENTS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = apply_sorted(events, ["phone", "cellid"], ["times", "register"], robust_rule, STAYS).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = robust(events).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_keys_nulls_and_order(spark):
    rows = [(None, 2, 1), (None, 1, 2), (3, 5, 3), (3, None, 4), (4, 1, 5)]
    frame = spark.createDataFrame(rows, "k long, o long, v long").repartition(3)

    def rule(key, chunks):
        yield (*key, [x for c in chunks for x in c["v"].to_pylist()])

    got = apply_sorted(frame, ["k"], ["o"], rule, "k bigint, vs array<bigint>").collect()
    assert sorted((str(r.k), r.vs) for r in got) == [("3", [4, 3]), ("4", [5]), ("None", [2, 1])]


def test_rule_may_stop_early_or_yield_nothing(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")

    def first(key, chunks):
        if key[0] != 1:
            yield (*key, next(chunks)["v"][0].as_py())

    got = apply_sorted(frame, ["k"], ["v"], first, "k bigint, v bigint").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (2, 2)]
    assert apply_sorted(frame.limit(0), ["k"], ["v"], first, "k bigint, v bigint").count() == 0


def test_group_larger_than_the_workers_memory(spark):
    """One group of 250 MB under 100 MB of free address space: a worker that
    held the group would fail, the streaming one passes."""
    frame = spark.range(0, 500_000, 1, 4).selectExpr("1L AS k", "id AS t", "repeat('x', 500) AS payload")

    def limited(key, chunks):
        def used():
            with open("/proc/self/statm") as f:
                return int(f.read().split()[0]) * resource.getpagesize()

        chunk = next(chunks)
        old = resource.getrlimit(resource.RLIMIT_AS)
        resource.setrlimit(resource.RLIMIT_AS, (used() + (100 << 20), old[1]))
        try:
            with pytest.raises((MemoryError, pa.ArrowMemoryError)):
                bytearray(200 << 20)
            n, size, last = 0, 0, -1
            while chunk is not None:
                times = chunk["t"].to_pylist()
                assert times[0] == last + 1
                n, size, last = n + len(times), size + chunk["payload"].nbytes, times[-1]
                chunk = next(chunks, None)
        finally:
            resource.setrlimit(resource.RLIMIT_AS, old)
        yield (*key, n, size)

    row = apply_sorted(frame, ["k"], ["t"], limited, "k bigint, n bigint, bytes bigint").first()
    assert row.n == 500_000 and row.bytes > 240 << 20
