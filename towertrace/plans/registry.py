"""Registered queries: one Spark callable (spark, sf_dir) -> DataFrame per
operator, plus the DuckDB twin of each.

Every query reads the whole driver tables (no id subsets, no row caps);
the only `limit` is the sampling query whose feature it is.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql as S
from ..functions.lines import csv_line, rowkey_tsv_line, subject_tsv_line
from ..functions.timefmt import format_time_of_day, seconds_of_day
from ..operators import checks
from ..operators.asof import asof_join
from ..operators.contacts import event_cuts, overlap_counts, overlapping_stays, subject_events, tag_subjects
from ..operators.groups import apply_sorted, robust_rule
from ..operators.intervals import intervals, with_ordinal, with_previous
from ..operators.shape import event_summary, replicate_events, split_visits_to_events, union_visits
from ..session import scratch_path, scratch_table
from ..sinks.text import write_lines, write_sorted_phones, write_table
from ..sources.tables import ensure_database, list_tables, load_managed_table, read_table, register_external_text_table
from ..sources.testdata import (
    cdr_from_events, load, stays_from_orders, subjects_from_customers, subjects_from_events,
    id_range, visits_from_events, visits_from_orders,
)
from ..sources.text import numbered_lines, read_checked_text, read_events_text, read_subjects_text
from .trace import trace, trace_stays, trace_to

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the generator queries.
REPLICA_COPIES = 3
REPLICA_PHONE_STRIDE = 1_000_000_000
REPLICA_CELL_STRIDE = 1_000_000

# The day and the density of the hot-tower query, and a density
# that has the sweeps of the test tables cut into pieces.
HOT_DAY = 20240101000000
HOT_ROWS = 200
PIECEWISE = {"split_rows": 2, "pieces": 4}


def _events(spark, d):
    return load(spark, d, "events")


def _cdr(spark, d):
    return cdr_from_events(_events(spark, d))


def _subjects(spark, d):
    return subjects_from_events(_events(spark, d))


def _inputs(spark, d):
    """The event view and the subject list, from one read of `events`."""
    ev = _events(spark, d)
    return cdr_from_events(ev), subjects_from_events(ev)


def _contacts(rule: str, include: bool, **sweep: int) -> Query:
    def q(spark, d):
        cdr, subj = _inputs(spark, d)
        return trace(cdr, subj, rule=rule, include=include, **sweep)
    return q


def q_contacts_hot_tower(spark, d):
    """One day, and one tower with the events of every third phone: its sweep
    is cut into pieces."""
    cdr, subj = _inputs(spark, d)
    hot = cdr.selectExpr("IF(phone % 3 = 0, 0, cellid) AS cellid", f"{HOT_DAY} + times % 1000000 AS times", "register", "phone")
    return trace(hot, subj, rule="robust", include=True, split_rows=HOT_ROWS, pieces=16)


def q_overlapping_stays(rule: str) -> Query:
    """The stays that overlap a subject's, not only their phones."""
    def q(spark, d):
        cdr, subj = _inputs(spark, d)
        return overlapping_stays(tag_subjects(intervals(cdr, rule), subj), cuts=event_cuts(cdr))
    return q


def _null_coded(spark, d):
    """The events with a null code in place of the other code."""
    return _cdr(spark, d).withColumn("register", F.expr("nullif(register, 0)"))


def _stays(rule: str, include_phone: bool = True) -> Query:
    def q(spark, d):
        return intervals(_cdr(spark, d), rule, include_phone=include_phone)
    return q


def _stay_lines(spark, d):
    """Phones of the robust stays, one per line in stay order, written as
    text and read back with line numbers."""
    st = intervals(_cdr(spark, d), "robust")
    path = write_sorted_phones(st, scratch_path(spark, "stay-lines"),
                               order_by=["enter_time", "exit_time", "cellid", "phone"])
    return numbered_lines(spark, path)


def _mixed_lines(spark, d):
    """One line per event in time order, good for codes 1 and 2, malformed for
    the other code."""
    cdr = _cdr(spark, d).orderBy("times", "cellid", "phone", "register")
    line = F.expr("CASE WHEN register = 0 THEN concat('bad ', phone) ELSE CAST(phone AS STRING) END")
    return numbered_lines(spark, write_lines(cdr.select(line.alias("line")), scratch_path(spark, "mixed-lines")))


def q_events_sorted_lines(spark, d):
    """Event export sorted by (cellid, times, register, phone): range-
    partitioned sort, CSV lines, read back with line numbers."""
    cdr = _cdr(spark, d)
    path = write_lines(cdr.orderBy("cellid", "times", "register", "phone").select(csv_line()),
                       scratch_path(spark, "events-sorted"))
    return numbered_lines(spark, path).drop("split")


def q_cdr_text_scan(spark, d):
    path = write_lines(_cdr(spark, d).select(csv_line()), scratch_path(spark, "cdr-csv"))
    return read_events_text(spark, path)


def q_subjects_text_scan(spark, d):
    path = write_lines(_subjects(spark, d).select("phone"), scratch_path(spark, "subjects"))
    return read_subjects_text(spark, path)


def q_contacts_text_lines(spark, d):
    cdr, subj = _inputs(spark, d)
    path = write_sorted_phones(trace(cdr, subj, include=True), scratch_path(spark, "contacts"))
    return numbered_lines(spark, path).drop("split")


def q_trace_job(spark, d):
    """The job's table and its text export, read back side by side."""
    cdr, subj = _inputs(spark, d)
    path = scratch_path(spark, "trace-text")
    table = trace_to(cdr, subj, scratch_table(spark, "contacts"), path, include=True)
    lines = read_subjects_text(spark, path).withColumnRenamed("phone", "line_phone")
    return table.join(lines, table["phone"] == lines["line_phone"], "full_outer")


def q_external_table_scan(spark, d):
    """The event lines as an external table, every eighth of them malformed."""
    line = F.when(F.col("phone") % 8 == 0, F.concat(F.lit("x"), csv_line())).otherwise(csv_line())
    path = write_lines(_cdr(spark, d).select(line.alias("line")), scratch_path(spark, "cdr-external"))
    return register_external_text_table(spark, scratch_table(spark, "cdr_external"), path)


def q_managed_table_overwrite(spark, d):
    """A managed table loaded twice: the second load replaces the first."""
    name = scratch_table(spark, "subjects")
    load_managed_table(spark, name, _cdr(spark, d).select("phone").distinct())
    load_managed_table(spark, name, _subjects(spark, d))
    return read_table(spark, name)


def q_table_as_select(spark, d):
    """Stays written as a table by the overwrite sink and scanned by name."""
    name = scratch_table(spark, "stays")
    write_table(intervals(_cdr(spark, d), "adjacent"), name)
    return spark.sql(f"SELECT phone, cellid, enter_time, exit_time FROM {name}")


def q_table_list(spark, d):
    """Tables of a fresh database, with their row counts."""
    base = scratch_table(spark, "db")
    ensure_database(spark, base)
    cdr, subj = _inputs(spark, d)
    write_table(cdr, f"{base}.cdinfo")
    write_table(subj, f"{base}.infected")
    names = list_tables(spark, base)
    return checks.table_counts(**{n: spark.table(f"{base}.{n}") for n in names})




def q_overlap_counts(spark, d):
    cdr, subj = _inputs(spark, d)
    return overlap_counts(intervals(cdr, "robust"), subj, cuts=event_cuts(cdr))


def q_first_exit_asof(spark, d):
    """The first-exit rule as an as-of join of two tables: the enters that
    start a run, and the exits."""
    cdr = _cdr(spark, d)
    starts = with_previous(cdr).where("register = 1 AND NOT (prev_register <=> 1)").selectExpr(
        "phone", "cellid", "times AS enter_time")
    exits = cdr.where("register = 2").selectExpr("phone", "cellid", "times AS exit_time")
    return asof_join(starts, exits, ["phone", "cellid"], "enter_time", "exit_time", how="inner", prefix="")


def q_next_subject_sighting(spark, d):
    """Every event with the next event of a subject on its tower."""
    cdr, subj = _inputs(spark, d)
    return asof_join(cdr, subject_events(cdr, subj).select("cellid", "times", "phone"), ["cellid"], "times", "times")


def q_table_replaced_after_failure(spark, d):
    """A table is written, a second write fails half way and leaves the old
    rows, and these are then replaced by rows read from the table itself."""
    cdr, subj = _inputs(spark, d)
    name = scratch_table(spark, "replaced")
    write_table(subj, name)
    broken = cdr.selectExpr("IF(times > 0, CAST(raise_error('a row that cannot be written') AS BIGINT), phone) AS phone")
    try:
        write_table(broken, name)
    except (PySparkException, Py4JJavaError) as error:
        if "a row that cannot be written" not in str(error):
            raise
    write_table(read_table(spark, name).selectExpr("phone + 1 AS phone"), name)
    return read_table(spark, name)


def q_merged_lines(spark, d):
    """The sorted event export joined into one file, read back with line numbers."""
    lines = _cdr(spark, d).orderBy("cellid", "times", "register", "phone").select(csv_line())
    return numbered_lines(spark, write_lines(lines, scratch_path(spark, "events-merged"), single_file=True)).drop("split")


def q_bad_event_lines(spark, d):
    """Event lines broken in five ways, by phone: the bad ones with their text
    and place."""
    line = F.expr("CASE pmod(phone, 8) WHEN 0 THEN concat('x', line) WHEN 1 THEN '' WHEN 2 THEN concat(line, ',9') "
                  "WHEN 3 THEN concat(line, '99999999999999999999') WHEN 4 THEN substring_index(line, ',', 2) ELSE line END")
    rows = _cdr(spark, d).orderBy("cellid", "times", "register", "phone").select("phone", csv_line().alias("line"))
    path = write_lines(rows.select(line.alias("line")), scratch_path(spark, "events-broken"))
    return read_checked_text(spark, path)[1].select("line_no", "line")


def q_phone_range_events(spark, d):
    """The events joined with the range of all phone numbers."""
    cdr = _cdr(spark, d)
    return subject_events(cdr, id_range(cdr, "phone"))


def q_reconcile(kind: str, rules: tuple[str, str] = ("first_exit", "robust")) -> Query:
    def q(spark, d):
        cdr, subj = _inputs(spark, d)
        expected, actual = (trace(cdr, subj, rule=r, include=True) for r in rules)
        if kind == "missing":
            return checks.missing(expected, actual)
        if kind == "extra":
            return checks.missing(actual, expected)
        return checks.reconcile_report(expected, actual)
    return q


def q_time_of_day(spark, d):
    ev = _events(spark, d)
    sec = (seconds_of_day("ts") + F.floor(F.col("value") * 100).cast("int") - 20000).cast("int")
    x = ev.select("event_id", F.date_format("ts", "yyyyMMdd").alias("day"), sec.alias("sec"))
    return x.select("event_id", "sec", format_time_of_day("day", "sec").alias("times"))


def _order_visits(spark, d):
    return visits_from_orders(load(spark, d, "orders"))


def q_union_visits(spark, d):
    return union_visits(visits_from_events(_events(spark, d)), _order_visits(spark, d))


def q_event_summary(spark, d):
    return event_summary(visits_from_events(_events(spark, d)), _order_visits(spark, d))


def q_stays_contacts(include: bool) -> Query:
    def q(spark, d):
        st = stays_from_orders(load(spark, d, "lineitem"), load(spark, d, "orders"))
        subj = subjects_from_customers(load(spark, d, "customer"))
        return trace_stays(st, subj, include=include)
    return q


QUERIES: dict[str, Query] = {
    # scans and sources
    "cdr_scan": lambda s, d: _cdr(s, d),
    "subjects_scan": lambda s, d: _subjects(s, d),
    "cdr_text_scan": q_cdr_text_scan,
    "subjects_text_scan": q_subjects_text_scan,
    "register_filter": lambda s, d: _cdr(s, d).where(F.col("register") == 1),
    "subject_events": lambda s, d: subject_events(*_inputs(s, d)),
    "cdr_sample": lambda s, d: _cdr(s, d).orderBy("cellid", "times", "register", "phone").limit(5),
    "table_counts": lambda s, d: checks.table_counts(**dict(zip(("cdr", "subjects"), _inputs(s, d)))),
    # catalog tables and the job with its sinks
    "external_table_scan": q_external_table_scan,
    "managed_table_overwrite": q_managed_table_overwrite,
    "table_as_select": q_table_as_select,
    "table_replaced_after_failure": q_table_replaced_after_failure,
    "table_list": q_table_list,
    "trace_job": q_trace_job,
    # windows
    "lag_register": lambda s, d: with_previous(_cdr(s, d)),
    "lag_register_nulls": lambda s, d: with_previous(_null_coded(s, d)),
    "event_ordinal": lambda s, d: with_ordinal(_cdr(s, d)),
    # the four rules
    "intervals_robust": _stays("robust"),
    "intervals_adjacent": _stays("adjacent"),
    "intervals_ordinal": _stays("ordinal"),
    "intervals_first_exit": _stays("first_exit"),
    "intervals_adjacent_nulls": lambda s, d: intervals(_null_coded(s, d), "adjacent"),
    "intervals_first_exit_nulls": lambda s, d: intervals(_null_coded(s, d), "first_exit"),
    "intervals_robust_nulls": lambda s, d: intervals(_null_coded(s, d), "robust"),
    "intervals_without_phone": _stays("robust", include_phone=False),
    "intervals_robust_rule": lambda s, d: apply_sorted(
        _cdr(s, d), ["phone", "cellid"], ["times", "register"], robust_rule,
        "phone bigint, cellid bigint, enter_time bigint, exit_time bigint"),
    # as-of joins
    "first_exit_asof": q_first_exit_asof,
    "next_subject_sighting": q_next_subject_sighting,
    # contacts
    "contacts_include": _contacts("robust", True),
    "contacts_exclude": _contacts("robust", False),
    "contacts_sweep_include": _contacts("robust", True, **PIECEWISE),
    "contacts_sweep_exclude": _contacts("robust", False, **PIECEWISE),
    "contacts_adjacent": _contacts("adjacent", True),
    "contacts_adjacent_exclude": _contacts("adjacent", False),
    "contacts_ordinal": _contacts("ordinal", True),
    "contacts_ordinal_exclude": _contacts("ordinal", False),
    "contacts_first_exit": _contacts("first_exit", True),
    "contacts_first_exit_exclude": _contacts("first_exit", False),
    "contacts_first_exit_sweep": _contacts("first_exit", True, **PIECEWISE),
    "contacts_hot_tower": q_contacts_hot_tower,
    "overlapping_stays": q_overlapping_stays("robust"),
    "overlapping_stays_ordinal": q_overlapping_stays("ordinal"),
    "overlap_counts": q_overlap_counts,
    "stays_contacts_include": q_stays_contacts(True),
    "stays_contacts_exclude": q_stays_contacts(False),
    # checks and reconciliation
    "reconcile_missing": q_reconcile("missing"),
    "reconcile_extra": q_reconcile("extra", ("adjacent", "robust")),
    "reconcile_report": q_reconcile("report"),
    "duplicate_groups": lambda s, d: checks.duplicate_groups(intervals(_cdr(s, d), "robust"), ["phone"]),
    "contacts_text_lines": q_contacts_text_lines,
    "mixed_lines_bad": lambda s, d: checks.bad_lines(_mixed_lines(s, d)),
    "mixed_lines_order_violations": lambda s, d: checks.order_violations(_mixed_lines(s, d)),
    "stay_lines_bad": lambda s, d: checks.bad_lines(_stay_lines(s, d)),
    "stay_lines_order_violations": lambda s, d: checks.order_violations(_stay_lines(s, d)),
    "stay_lines_duplicates": lambda s, d: checks.duplicate_values(_stay_lines(s, d).select("line"), ["line"]),
    # export formats
    "events_csv_lines": lambda s, d: _cdr(s, d).select(csv_line().alias("line")),
    "events_sorted_lines": q_events_sorted_lines,
    "merged_lines": q_merged_lines,
    "bad_event_lines": q_bad_event_lines,
    "rowkey_tsv_lines": lambda s, d: _cdr(s, d).select(rowkey_tsv_line().alias("line")),
    "subject_tsv_lines": lambda s, d: _subjects(s, d).select(subject_tsv_line().alias("line")),
    # reshaping and scale-up
    "format_time_of_day": q_time_of_day,
    "split_visits_to_events": lambda s, d: split_visits_to_events(visits_from_events(_events(s, d))),
    "replicate_events": lambda s, d: replicate_events(
        _cdr(s, d), REPLICA_COPIES, REPLICA_PHONE_STRIDE, REPLICA_CELL_STRIDE),
    "phone_range_events": q_phone_range_events,
    "union_visits": q_union_visits,
    "event_summary": q_event_summary,
}


_W = S.with_
SQL: dict[str, str] = {
    "cdr_scan": _W(S.CDR) + "SELECT cellid, times, register, phone FROM cdr",
    "subjects_scan": _W(S.SUBJECTS) + "SELECT phone FROM subjects",
    "cdr_text_scan": _W(S.CDR) + "SELECT cellid, times, register, phone FROM cdr",
    "subjects_text_scan": _W(S.SUBJECTS) + "SELECT phone FROM subjects",
    "register_filter": _W(S.CDR) + "SELECT cellid, times, register, phone FROM cdr WHERE register = 1",
    "subject_events": _W(S.CDR, S.SUBJECTS) +
        "SELECT phone, cellid, times, register FROM cdr WHERE phone IN (SELECT phone FROM subjects)",
    "cdr_sample": _W(S.CDR) +
        "SELECT cellid, times, register, phone FROM cdr ORDER BY cellid, times, register, phone LIMIT 5",
    "table_counts": _W(S.CDR, S.SUBJECTS) +
        "SELECT 'cdr' AS \"table\", count(*) AS \"rows\" FROM cdr "
        "UNION ALL SELECT 'subjects', count(*) FROM subjects",
    "lag_register": _W(S.CDR, S.previous("p")) +
        "SELECT phone, cellid, times, register, prev_register, prev_time FROM p",
    "lag_register_nulls": _W(S.CDR, S.NULL_CODED, S.previous("p", "ncdr")) +
        "SELECT phone, cellid, times, register, prev_register, prev_time FROM p",
    "intervals_adjacent_nulls": _W(S.CDR, S.NULL_CODED, S.adjacent("st", "ncdr")) + "SELECT * FROM st",
    "intervals_first_exit_nulls": _W(S.CDR, S.NULL_CODED, S.first_exit("st", "ncdr")) + "SELECT * FROM st",
    "intervals_robust_nulls": _W(S.CDR, S.NULL_CODED, S.robust("st", "ncdr")) + "SELECT * FROM st",
    "external_table_scan": _W(S.CDR) + "SELECT cellid, times, register, phone FROM cdr WHERE phone % 8 <> 0",
    "managed_table_overwrite": _W(S.SUBJECTS) + "SELECT phone FROM subjects",
    "table_as_select": _W(S.CDR, S.adjacent("st")) + "SELECT * FROM st",
    "table_list": _W(S.CDR, S.SUBJECTS) +
        "SELECT 'cdinfo' AS \"table\", count(*) AS \"rows\" FROM cdr UNION ALL SELECT 'infected', count(*) FROM subjects",
    "trace_job": _W(S.CDR, S.SUBJECTS, S.robust("st"), S.contacts("c", "st", True)) +
        "SELECT phone, phone AS line_phone FROM c",
    "overlapping_stays": S.overlapping_sql("robust"),
    "overlapping_stays_ordinal": S.overlapping_sql("ordinal"),
    "phone_range_events": _W(S.CDR) + "SELECT phone, cellid, times, register FROM cdr",
    "intervals_robust_rule": _W(S.CDR, S.robust("st")) + "SELECT * FROM st",
    "first_exit_asof": _W(S.CDR, S.first_exit("st")) + "SELECT * FROM st",
    "next_subject_sighting": _W(S.CDR, S.SUBJECTS) + """
SELECT e.cellid, e.times, e.register, e.phone, s.times AS next_times, s.phone AS next_phone
FROM cdr e ASOF LEFT JOIN (
  SELECT cellid, times, min(phone) AS phone FROM cdr
  WHERE phone IN (SELECT phone FROM subjects) GROUP BY cellid, times) s
  ON e.cellid = s.cellid AND e.times <= s.times""",
    "contacts_hot_tower": _W(S.CDR, S.SUBJECTS, f"""hot AS (
  SELECT CASE WHEN phone % 3 = 0 THEN 0 ELSE cellid END AS cellid, {HOT_DAY} + times % 1000000 AS times, register, phone
  FROM cdr)""", S.robust("st", "hot"), S.contacts("c", "st", True)) + "SELECT phone FROM c",
    "table_replaced_after_failure": _W(S.SUBJECTS) + "SELECT phone + 1 AS phone FROM subjects",
    "merged_lines": _W(S.CDR) +
        "SELECT row_number() OVER (ORDER BY cellid, times, register, phone) AS line_no, "
        "concat_ws(',', CAST(cellid AS VARCHAR), CAST(times AS VARCHAR), "
        "CAST(register AS VARCHAR), CAST(phone AS VARCHAR)) AS line FROM cdr",
    "bad_event_lines": _W(S.CDR, """l AS (
  SELECT row_number() OVER (ORDER BY cellid, times, register, phone) AS line_no, phone % 8 AS how,
         CAST(cellid AS VARCHAR) || ',' || CAST(times AS VARCHAR) AS short,
         concat_ws(',', CAST(cellid AS VARCHAR), CAST(times AS VARCHAR),
                   CAST(register AS VARCHAR), CAST(phone AS VARCHAR)) AS line
  FROM cdr)""") + """
SELECT line_no, CASE how WHEN 0 THEN 'x' || line WHEN 1 THEN '' WHEN 2 THEN line || ',9'
                         WHEN 3 THEN line || '99999999999999999999' ELSE short END AS line
FROM l WHERE how <= 4""",
    "mixed_lines_bad": _W(S.CDR, S.MIXED) + "SELECT line_no, line FROM l WHERE NOT good",
    "mixed_lines_order_violations": _W(S.CDR, S.MIXED) + """
SELECT line_no, prev_line, line FROM (
  SELECT line_no, line, lag(line) OVER (ORDER BY line_no) AS prev_line FROM l WHERE good) x
WHERE CAST(line AS BIGINT) < CAST(prev_line AS BIGINT)""",
    "event_ordinal": _W(S.CDR, S.ordinal_rank("o")) +
        "SELECT phone, cellid, times, register, idx FROM o",
    "intervals_robust": _W(S.CDR, S.robust("st")) + "SELECT * FROM st",
    "intervals_adjacent": _W(S.CDR, S.adjacent("st")) + "SELECT * FROM st",
    "intervals_ordinal": _W(S.CDR, S.ordinal("st")) + "SELECT * FROM st",
    "intervals_first_exit": _W(S.CDR, S.first_exit("st")) + "SELECT * FROM st",
    "intervals_without_phone": _W(S.CDR, S.robust("st")) +
        "SELECT cellid, enter_time, exit_time FROM st",
    "contacts_include": S.rule_contacts_sql("robust", True),
    "contacts_exclude": S.rule_contacts_sql("robust", False),
    "contacts_sweep_include": S.rule_contacts_sql("robust", True),
    "contacts_sweep_exclude": S.rule_contacts_sql("robust", False),
    "contacts_adjacent": S.rule_contacts_sql("adjacent", True),
    "contacts_adjacent_exclude": S.rule_contacts_sql("adjacent", False),
    "contacts_ordinal": S.rule_contacts_sql("ordinal", True),
    "contacts_ordinal_exclude": S.rule_contacts_sql("ordinal", False),
    "contacts_first_exit": S.rule_contacts_sql("first_exit", True),
    "contacts_first_exit_exclude": S.rule_contacts_sql("first_exit", False),
    "contacts_first_exit_sweep": S.rule_contacts_sql("first_exit", True),
    "overlap_counts": _W(S.CDR, S.SUBJECTS, S.robust("st")) + """
SELECT a.phone, a.cellid, a.enter_time, a.exit_time, count(*) AS overlaps
FROM (SELECT DISTINCT * FROM st) a
JOIN (SELECT * FROM st WHERE phone IN (SELECT phone FROM subjects)) i
  ON a.cellid = i.cellid AND a.enter_time <= i.exit_time AND a.exit_time >= i.enter_time
GROUP BY a.phone, a.cellid, a.enter_time, a.exit_time""",
    "stays_contacts_include": _W(S.ORDER_STAYS, S.contacts("c", "ostays", True, "osubjects")) +
        "SELECT phone FROM c",
    "stays_contacts_exclude": _W(S.ORDER_STAYS, S.contacts("c", "ostays", False, "osubjects")) +
        "SELECT phone FROM c",
    "reconcile_missing": _W(S.CDR, S.SUBJECTS, S.first_exit("fe"), S.robust("rb"),
                            S.contacts("e", "fe", True), S.contacts("a", "rb", True)) +
        "SELECT phone FROM e WHERE phone NOT IN (SELECT phone FROM a)",
    "reconcile_extra": _W(S.CDR, S.SUBJECTS, S.adjacent("ad"), S.robust("rb"),
                          S.contacts("e", "ad", True), S.contacts("a", "rb", True)) +
        "SELECT phone FROM a WHERE phone NOT IN (SELECT phone FROM e)",
    "reconcile_report": _W(S.CDR, S.SUBJECTS, S.first_exit("fe"), S.robust("rb"),
                           S.contacts("e", "fe", True), S.contacts("a", "rb", True)) + """
SELECT 'expected_count' AS metric, count(*) AS value FROM e
UNION ALL SELECT 'actual_count', count(*) FROM a
UNION ALL SELECT 'missing_in_actual', count(*) FROM e WHERE phone NOT IN (SELECT phone FROM a)
UNION ALL SELECT 'extra_in_actual', count(*) FROM a WHERE phone NOT IN (SELECT phone FROM e)
UNION ALL SELECT 'duplicate_groups_in_actual', count(*) FROM
  (SELECT phone FROM a GROUP BY phone HAVING count(*) > 1) t""",
    "duplicate_groups": _W(S.CDR, S.robust("st")) +
        "SELECT count(*) AS duplicate_groups FROM (SELECT phone FROM st GROUP BY phone HAVING count(*) > 1) t",
    "contacts_text_lines": S.contact_lines_sql(),
    "stay_lines_bad": _W(S.CDR, S.robust("st"), S.stay_lines()) +
        "SELECT line_no, line FROM l WHERE NOT regexp_matches(line, '^[ \\t]*[0-9]+[ \\t]*$')",
    "stay_lines_order_violations": _W(S.CDR, S.robust("st"), S.stay_lines()) + """
SELECT c.line_no, p.line AS prev_line, c.line
FROM l c JOIN l p ON p.line_no = c.line_no - 1
WHERE CAST(c.line AS BIGINT) < CAST(p.line AS BIGINT)""",
    "stay_lines_duplicates": _W(S.CDR, S.robust("st"), S.stay_lines()) +
        "SELECT line, count(*) AS n FROM l GROUP BY line HAVING count(*) > 1",
    "events_csv_lines": _W(S.CDR) +
        "SELECT concat_ws(',', CAST(cellid AS VARCHAR), CAST(times AS VARCHAR), "
        "CAST(register AS VARCHAR), CAST(phone AS VARCHAR)) AS line FROM cdr",
    "events_sorted_lines": _W(S.CDR) +
        "SELECT row_number() OVER (ORDER BY cellid, times, register, phone) AS line_no, "
        "concat_ws(',', CAST(cellid AS VARCHAR), CAST(times AS VARCHAR), "
        "CAST(register AS VARCHAR), CAST(phone AS VARCHAR)) AS line FROM cdr",
    "rowkey_tsv_lines": _W(S.CDR) +
        "SELECT concat_ws(chr(9), concat_ws('_', CAST(cellid AS VARCHAR), CAST(times AS VARCHAR), "
        "CAST(phone AS VARCHAR), CAST(register AS VARCHAR)), CAST(cellid AS VARCHAR), "
        "CAST(times AS VARCHAR), CAST(register AS VARCHAR), CAST(phone AS VARCHAR)) AS line FROM cdr",
    "subject_tsv_lines": _W(S.SUBJECTS) +
        "SELECT concat_ws(chr(9), CAST(phone AS VARCHAR), CAST(phone AS VARCHAR)) AS line FROM subjects",
    "format_time_of_day": """
SELECT event_id, sec, """ + S.time_of_day("day", "sec") + """ AS times FROM (
  SELECT event_id, strftime(ts, '%Y%m%d') AS day,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts)
              + CAST(floor(value * 100) AS INTEGER) - 20000 AS INTEGER) AS sec
  FROM events) t""",
    "split_visits_to_events": _W(S.VISITS) + f"""
SELECT cellid, {S.time_of_day("day", "enterSec")} AS times, 1 AS register, phone FROM visits
UNION ALL
SELECT cellid, {S.time_of_day("day", "exitSec")} AS times, 2 AS register, phone FROM visits""",
    "replicate_events": _W(S.CDR) + f"""
SELECT cellid + CAST(c AS BIGINT) * {REPLICA_CELL_STRIDE} AS cellid, times, register,
       phone + CAST(c AS BIGINT) * {REPLICA_PHONE_STRIDE} AS phone, CAST(c AS INTEGER) AS copy
FROM cdr, range({REPLICA_COPIES}) t(c)""",
    "union_visits": _W(S.VISITS, S.ORDER_VISITS) +
        "SELECT phone, cellid, day, enterSec, exitSec FROM visits "
        "UNION ALL SELECT phone, cellid, day, enterSec, exitSec FROM ovisits",
    "event_summary": _W(S.VISITS, S.ORDER_VISITS) + """
SELECT (SELECT count(*) FROM visits) AS normal_visits,
       (SELECT count(*) FROM ovisits) AS planted_visits,
       (SELECT count(DISTINCT phone) FROM ovisits) AS planted_phones,
       ((SELECT count(*) FROM visits) + (SELECT count(*) FROM ovisits)) * 2 AS event_rows""",
}

assert set(SQL) <= set(QUERIES), set(SQL) - set(QUERIES)
