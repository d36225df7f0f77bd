"""Times of the headline queries in the plain plan shape.

    BENCH_SF_DIR=/root/testdata/sf0.1 python scripts/baseline_times.py

The shape a direct transcription of the job would have on the same Spark: the
robust rule collects and walks each (phone, tower) group, the other rules use
one window or self-join per key, contacts are an inner join of the stays on the
tower with the overlap as condition, then distinct, and each rule is run anew
wherever it is named.  Row counts are compared with the registered queries.
Prints one JSON line: median seconds of three warm runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from towertrace.plans import oracle_sql as S  # noqa: E402

CLOSES = ("r.register = 2 AND a.open IS NOT NULL AND "
          "(get(rows, a.i + 1) IS NULL OR get(rows, a.i + 1).register = 1)")
WALK = f"""st AS (
  SELECT phone, cellid, s.e AS enter_time, s.x AS exit_time FROM (
    SELECT phone, cellid, explode(aggregate(rows,
      named_struct('open', CAST(NULL AS BIGINT), 'i', 0, 'out', CAST(array() AS ARRAY<STRUCT<e: BIGINT, x: BIGINT>>)),
      (a, r) -> named_struct(
        'open', CASE WHEN r.register = 1 AND a.open IS NULL THEN r.times WHEN {CLOSES} THEN NULL ELSE a.open END,
        'i', a.i + 1,
        'out', IF({CLOSES}, concat(a.out, array(named_struct('e', a.open, 'x', r.times))), a.out)),
      a -> a.out)) AS s
    FROM (SELECT phone, cellid, sort_array(collect_list(struct(times, register))) AS rows
          FROM cdr GROUP BY phone, cellid)))"""
COUNTS = """SELECT a.phone, a.cellid, a.enter_time, a.exit_time, count(*) AS overlaps
FROM (SELECT DISTINCT * FROM st) a JOIN (SELECT * FROM st WHERE phone IN (SELECT phone FROM subjects)) i
  ON a.cellid = i.cellid AND a.enter_time <= i.exit_time AND a.exit_time >= i.enter_time
GROUP BY a.phone, a.cellid, a.enter_time, a.exit_time"""
REPORT = """SELECT 'expected_count' AS metric, count(*) AS value FROM e
UNION ALL SELECT 'actual_count', count(*) FROM c
UNION ALL SELECT 'missing_in_actual', count(*) FROM e WHERE phone NOT IN (SELECT phone FROM c)
UNION ALL SELECT 'extra_in_actual', count(*) FROM c WHERE phone NOT IN (SELECT phone FROM e)
UNION ALL SELECT 'duplicate_groups_in_actual', count(*) FROM (SELECT phone FROM c GROUP BY phone HAVING count(*) > 1) t"""

PLAIN = {
    "intervals_robust": S.with_(WALK) + "SELECT * FROM st",
    "intervals_adjacent": S.with_(S.adjacent("st")) + "SELECT * FROM st",
    "intervals_ordinal": S.with_(S.ordinal("st")) + "SELECT * FROM st",
    "intervals_first_exit": S.with_(S.first_exit("st")) + "SELECT * FROM st",
    "contacts_include": S.with_(WALK, S.contacts("c", "st", True)) + "SELECT phone FROM c",
    "contacts_exclude": S.with_(WALK, S.contacts("c", "st", False)) + "SELECT phone FROM c",
    "contacts_first_exit": S.with_(S.first_exit("st"), S.contacts("c", "st", True)) + "SELECT phone FROM c",
    "overlap_counts": S.with_(WALK) + COUNTS,
    "stays_contacts_include": S.with_(S.contacts("c", "ostays", True, "osubjects")) + "SELECT phone FROM c",
    "reconcile_report": S.with_(WALK, S.contacts("c", "st", True), S.first_exit("fe"), S.contacts("e", "fe", True)) + REPORT,
}
PLAIN["contacts_sweep_include"] = PLAIN["contacts_include"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from towertrace.plans.registry import QUERIES
    from towertrace.session import build_session
    from towertrace.sources import cdr_from_events, load, stays_from_orders, subjects_from_customers, subjects_from_events

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    events = load(spark, sf_dir, "events")
    cdr_from_events(events).createOrReplaceTempView("cdr")
    subjects_from_events(events).createOrReplaceTempView("subjects")
    stays_from_orders(load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")).createOrReplaceTempView("ostays")
    subjects_from_customers(load(spark, sf_dir, "customer")).createOrReplaceTempView("osubjects")
    times = {}
    for key, sql in PLAIN.items():
        assert spark.sql(sql).count() == QUERIES[key](spark, sf_dir).count(), key
        taken = []
        for _ in range(3):
            started = time.perf_counter()
            spark.sql(sql).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[key] = round(statistics.median(taken), 3)
    spark.stop()
    print(json.dumps({"metric": "plain_shape_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}))


if __name__ == "__main__":
    main()
