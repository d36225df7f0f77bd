"""Prefix sums as a tree of windows, and what is built on them."""

import random

import pytest

from towertrace.operators.scan import exclusive_scan
from towertrace.sources import numbered_lines
from towertrace.operators import checks


@pytest.mark.parametrize("fanout", [2, 5, 4096])
def test_scan_against_a_loop(spark, fanout):
    rnd = random.Random(fanout)
    order = sorted(rnd.sample(range(300), 60))
    rows = [(o, rnd.choice([None, rnd.randint(-5, 9)]), rnd.randint(0, 99)) for o in order]
    frame = spark.createDataFrame(rows, "o long, a long, b long").selectExpr("o", "a", "named_struct('x', b, 'o', o) AS s").repartition(4)
    got = {r.o: (r.before_a, tuple(r.before_s) if r.before_s else None) for r in
           exclusive_scan(frame, "o", fanout, a="sum", s="max").collect()}
    want = {}
    for i, (o, _, _) in enumerate(rows):
        known = [a for _, a, _ in rows[:i] if a is not None]
        want[o] = (sum(known) if known else None, max(((b, p) for p, _, b in rows[:i]), default=None))
    assert got == want
    assert exclusive_scan(frame.limit(0), "o", a="sum").count() == 0
    with pytest.raises(ValueError):
        exclusive_scan(frame, "o", a="min")


def test_numbering_and_order_check_have_no_open_window(spark, tmp_path):
    """Every window of the two plans has a partition."""
    (tmp_path / "a b.txt").write_text("1\n2\n")
    numbered = numbered_lines(spark, str(tmp_path))
    for frame in (numbered, checks.order_violations(numbered)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "SinglePartition" not in plan


def test_many_files_and_splits(spark, tmp_path):
    """Numbers over 40 files cut into small splits are those of one text."""
    rnd = random.Random(3)
    lines = []
    for i in range(40):
        part = [str(rnd.randint(0, 50)) if rnd.random() < .9 else "bad" for _ in range(rnd.choice([0, 1, 30]))]
        (tmp_path / f"part {i:03d}%20ü.txt").write_text("".join(x + "\n" for x in part))
        lines += part
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        numbered = numbered_lines(spark, str(tmp_path))
        got = [(r.line_no, r.line) for r in numbered.orderBy("line_no").collect()]
        violations = sorted((r.line_no, r.prev_line, r.line) for r in checks.order_violations(numbered).collect())
        splits = numbered.select("split").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(enumerate(lines, 1)) and splits > 40
    want, last = [], None
    for i, line in enumerate(lines, 1):
        if line.isdigit():
            if last is not None and int(line) < int(last):
                want.append((i, last, line))
            last = line
    assert violations == want and want
