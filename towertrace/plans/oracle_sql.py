"""DuckDB SQL twins of the registered queries.

They take the plainest form of each rule (single window per key, self-joins,
inner join + distinct for contacts; the robust rule keeps the close-and-segment
form of the Spark code), over the same parquet tables.  Ties inside a key are ordered by
(times, register), as in the Spark code.
"""

from __future__ import annotations

# Must equal the adapters in sources/testdata.py.
SUBJECT_MIN_VALUE = 300
CUSTOMER_MIN_BALANCE = 9900

CDR = """cdr AS (
  SELECT * FROM (
    SELECT TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS cellid,
           CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS times,
           CAST(CASE WHEN event_type IN ('click', 'view') THEN 1
                     WHEN event_type IN ('purchase', 'error') THEN 2
                     ELSE 0 END AS INTEGER) AS register,
           CAST(user_id AS BIGINT) AS phone
    FROM events) t
  WHERE cellid IS NOT NULL AND times IS NOT NULL AND phone IS NOT NULL)"""

SUBJECTS = f"""subjects AS (
  SELECT DISTINCT CAST(user_id AS BIGINT) AS phone FROM events
  WHERE value >= {SUBJECT_MIN_VALUE} AND user_id IS NOT NULL)"""

NULL_CODED = "ncdr AS (SELECT * REPLACE (nullif(register, 0) AS register) FROM cdr)"

MIXED = """l AS (
  SELECT row_number() OVER (ORDER BY times, cellid, phone, register) AS line_no, register <> 0 AS good,
         CASE WHEN register = 0 THEN 'bad ' || CAST(phone AS VARCHAR) ELSE CAST(phone AS VARCHAR) END AS line
  FROM cdr)"""

ORDER_VISITS = """ovisits AS (
  SELECT CAST(o_custkey AS BIGINT) AS phone, CAST(o_orderkey AS BIGINT) AS cellid,
         strftime(o_orderdate, '%Y%m%d') AS day, CAST(o_orderkey % 40000 AS INTEGER) AS enterSec,
         CAST(o_orderkey % 40000 + 1 + o_custkey % 3600 AS INTEGER) AS exitSec
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL)"""

VISITS = """visits AS (
  SELECT * FROM (
    SELECT CAST(user_id AS BIGINT) AS phone,
           TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS cellid,
           strftime(ts, '%Y%m%d') AS day,
           CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS enterSec,
           CAST(least(hour(ts) * 3600 + minute(ts) * 60 + second(ts)
                      + CAST(floor(value * 60) AS INTEGER), 86399) AS INTEGER) AS exitSec
    FROM events) t
  WHERE phone IS NOT NULL AND cellid IS NOT NULL AND enterSec < exitSec)"""

ORDER_STAYS = """ostays AS (
  SELECT * FROM (
    SELECT CAST(o_custkey AS BIGINT) AS phone, CAST(l_partkey AS BIGINT) AS cellid,
           CAST(strftime(least(o_orderdate, l_shipdate), '%Y%m%d%H%M%S') AS BIGINT) AS enter_time,
           CAST(strftime(greatest(o_orderdate, l_shipdate), '%Y%m%d%H%M%S') AS BIGINT) AS exit_time
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
  WHERE enter_time IS NOT NULL AND exit_time IS NOT NULL),
osubjects AS (
  SELECT DISTINCT CAST(c_custkey AS BIGINT) AS phone FROM customer
  WHERE c_acctbal >= """ + str(CUSTOMER_MIN_BALANCE) + ")"

KEY_ORDER = "PARTITION BY phone, cellid ORDER BY times, register NULLS FIRST"


def robust(name: str, src: str = "cdr") -> str:
    return f"""{name}_w AS (
  SELECT phone, cellid, times, register,
         lead(register, 1, 1) OVER ({KEY_ORDER}) AS nxt
  FROM {src}),
{name}_s AS (
  SELECT *, CASE WHEN register = 2 AND nxt = 1 THEN 1 ELSE 0 END AS cl FROM {name}_w),
{name}_g AS (
  SELECT *, coalesce(sum(cl) OVER ({KEY_ORDER}
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM {name}_s),
{name} AS (
  SELECT phone, cellid, enter_time, exit_time FROM (
    SELECT phone, cellid,
           min(CASE WHEN register = 1 THEN times END) AS enter_time,
           max(CASE WHEN cl = 1 THEN times END) AS exit_time
    FROM {name}_g GROUP BY phone, cellid, seg) t
  WHERE enter_time IS NOT NULL AND exit_time IS NOT NULL)"""


def previous(name: str, src: str = "cdr") -> str:
    return f"""{name} AS (
  SELECT phone, cellid, times, register,
         lag(register) OVER ({KEY_ORDER}) AS prev_register,
         lag(times) OVER ({KEY_ORDER}) AS prev_time
  FROM {src})"""


def adjacent(name: str, src: str = "cdr") -> str:
    return previous(f"{name}_l", src) + f""",
{name} AS (
  SELECT phone, cellid, prev_time AS enter_time, times AS exit_time
  FROM {name}_l WHERE prev_register = 1 AND register = 2)"""


def ordinal_rank(name: str, src: str = "cdr") -> str:
    return f"""{name} AS (
  SELECT phone, cellid, times, register,
         row_number() OVER (PARTITION BY phone, cellid, register ORDER BY times) - 1 AS idx
  FROM {src} WHERE register IN (1, 2))"""


def ordinal(name: str, src: str = "cdr") -> str:
    return ordinal_rank(f"{name}_r", src) + f""",
{name} AS (
  SELECT e.phone, e.cellid, e.times AS enter_time, x.times AS exit_time
  FROM {name}_r e JOIN {name}_r x
    ON e.phone = x.phone AND e.cellid = x.cellid AND e.idx = x.idx
  WHERE e.register = 1 AND x.register = 2)"""


def first_exit(name: str, src: str = "cdr") -> str:
    return f"""{name}_e AS (
  SELECT phone, cellid, times, register,
         lag(register) OVER ({KEY_ORDER}) AS prev_register
  FROM {src}),
{name} AS (
  SELECT e.phone, e.cellid, e.times AS enter_time, min(x.times) AS exit_time
  FROM {name}_e e JOIN {src} x
    ON e.phone = x.phone AND e.cellid = x.cellid AND x.register = 2 AND x.times >= e.times
  WHERE e.register = 1 AND (e.prev_register IS NULL OR e.prev_register <> 1)
  GROUP BY e.phone, e.cellid, e.times)"""


RULE_CTE = {"robust": robust, "adjacent": adjacent, "ordinal": ordinal, "first_exit": first_exit}


def contacts(name: str, stays: str, include: bool, subjects: str = "subjects") -> str:
    body = f"""SELECT DISTINCT a.phone FROM {stays} i JOIN {stays} a
    ON a.cellid = i.cellid AND a.enter_time <= i.exit_time AND a.exit_time >= i.enter_time
  WHERE i.phone IN (SELECT phone FROM {subjects})"""
    if not include:
        body = f"SELECT phone FROM ({body}) c WHERE phone NOT IN (SELECT phone FROM {subjects})"
    return f"{name} AS ({body})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rule_contacts_sql(rule: str, include: bool) -> str:
    return with_(CDR, SUBJECTS, RULE_CTE[rule]("st"), contacts("c", "st", include)) + \
        "SELECT phone FROM c"


def contact_lines_sql() -> str:
    return with_(CDR, SUBJECTS, robust("st"), contacts("c", "st", True)) + \
        "SELECT row_number() OVER (ORDER BY phone) AS line_no, CAST(phone AS VARCHAR) AS line FROM c"


def stay_lines(name: str = "l") -> str:
    return f"""{name} AS (
  SELECT row_number() OVER (ORDER BY enter_time, exit_time, cellid, phone) AS line_no,
         CAST(phone AS VARCHAR) AS line
  FROM st)"""


def time_of_day(day: str, sec: str) -> str:
    s = f"least(greatest({sec}, 0), 86399)"
    return (f"CAST({day} || lpad(CAST({s} // 3600 AS VARCHAR), 2, '0')"
            f" || lpad(CAST(({s} % 3600) // 60 AS VARCHAR), 2, '0')"
            f" || lpad(CAST({s} % 60 AS VARCHAR), 2, '0') AS BIGINT)")


def overlapping_sql(rule: str) -> str:
    return with_(CDR, SUBJECTS, RULE_CTE[rule]("st")) + """
SELECT a.phone, a.cellid, a.enter_time, a.exit_time,
       a.phone IN (SELECT phone FROM subjects) AS is_subject
FROM st a WHERE EXISTS (
  SELECT 1 FROM st i WHERE i.phone IN (SELECT phone FROM subjects) AND a.cellid = i.cellid
    AND a.enter_time <= i.exit_time AND a.exit_time >= i.enter_time)"""
