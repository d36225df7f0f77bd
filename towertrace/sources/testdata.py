"""Views that adapt the driver's parquet tables to the event data model.

`events` becomes the event table: a user is a phone, the `k` field of
`props` is the tower, the event type gives the code.  Nothing is sampled or
capped: every row of the source table flows into the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import seconds_of_day, times_sql, ts_to_times
from ..schema import ENTER, EXIT, LAST_SECOND_OF_DAY

# Event types of the test table mapped to codes; any other
# type (signup) becomes code 0.
ENTER_TYPES = ("click", "view")
EXIT_TYPES = ("purchase", "error")
OTHER_CODE = 0

# Default subject rules of the adapters.
SUBJECT_MIN_VALUE = 300.0      # a user with any event value >= this is a subject
CUSTOMER_MIN_BALANCE = 9900.0  # a customer with balance >= this is a subject


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tower_of(props) -> F.Column:
    p = F.col(props) if isinstance(props, str) else props
    return F.get_json_object(p, "$.k").try_cast("long")


def _register_sql(event_type: str) -> str:
    enters = ", ".join(f"'{t}'" for t in ENTER_TYPES)
    exits = ", ".join(f"'{t}'" for t in EXIT_TYPES)
    return (f"CAST(CASE WHEN `{event_type}` IN ({enters}) THEN {ENTER} "
            f"WHEN `{event_type}` IN ({exits}) THEN {EXIT} ELSE {OTHER_CODE} END AS INT)")


def cdr_from_events(events: DataFrame) -> DataFrame:
    """(cellid, times, register, phone); rows with a missing field dropped.
    The source columns are tested in the scan, the tower after it is read
    from the JSON field once."""
    rows = events.where("ts IS NOT NULL AND user_id IS NOT NULL").selectExpr(
        "try_cast(get_json_object(props, '$.k') AS BIGINT) AS cellid",
        f"{times_sql('ts')} AS times",
        f"{_register_sql('event_type')} AS register",
        "CAST(user_id AS BIGINT) AS phone",
    )
    return rows.where("cellid IS NOT NULL")


def subjects_from_events(events: DataFrame, min_value: float = SUBJECT_MIN_VALUE) -> DataFrame:
    """Distinct phones that reported a value of at least `min_value`."""
    return (events.where(f"value >= {float(min_value)!r} AND user_id IS NOT NULL")
            .selectExpr("CAST(user_id AS BIGINT) AS phone").distinct())


def visits_from_events(events: DataFrame) -> DataFrame:
    """Visits inside one day: enter at the event's second of day, stay
    `floor(value * 60)` seconds, cut at the day's end; empty ones dropped.
    Columns: phone, cellid, day (`yyyyMMdd`), enterSec, exitSec."""
    enter = seconds_of_day("ts")
    exit_ = F.least(enter + F.floor(F.col("value") * 60).cast("int"),
                    F.lit(LAST_SECOND_OF_DAY)).cast("int")
    return (
        events.select(
            F.col("user_id").cast("long").alias("phone"),
            tower_of("props").alias("cellid"),
            F.date_format("ts", "yyyyMMdd").alias("day"),
            enter.alias("enterSec"),
            exit_.alias("exitSec"),
        )
        .where(F.col("phone").isNotNull() & F.col("cellid").isNotNull()
               & (F.col("enterSec") < F.col("exitSec")))
    )


def visits_from_orders(orders: DataFrame) -> DataFrame:
    """A second visit table: each order is a visit of its customer (phone) to
    a tower of its own, at a second of the day given by the order key."""
    enter = F.col("o_orderkey") % 40000
    return orders.where("o_custkey IS NOT NULL AND o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL").select(
        F.col("o_custkey").cast("long").alias("phone"), F.col("o_orderkey").cast("long").alias("cellid"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"), enter.cast("int").alias("enterSec"),
        (enter + 1 + F.col("o_custkey") % 3600).cast("int").alias("exitSec"))


#: Ids that one task of `id_range` makes at a time.
RANGE_CHUNK = 65_536


def id_range(df: DataFrame, column: str) -> DataFrame:
    """All whole numbers from the least to the largest value of a column, as
    one plan: the bounds are an aggregate, its row is unfolded to one row per
    chunk, and the chunks are dealt out before each makes its ids.  Nothing
    runs while the plan is built; without a value the range is empty."""
    size = RANGE_CHUNK
    bounds = df.agg(F.min(column).cast("bigint").alias("_lo"), F.max(column).cast("bigint").alias("_hi")).where("_lo IS NOT NULL")
    floor = "CAST(floor({} / CAST({} AS DECIMAL(20, 0))) AS BIGINT)".format
    chunks = bounds.selectExpr("_lo", "_hi", f"explode(sequence({floor('_lo', size)}, {floor('_hi', size)})) AS _c").repartition("_c")
    return chunks.selectExpr(f"explode(sequence(greatest(_lo, _c * {size}), least(_hi, _c * {size} + {size - 1}))) AS {column}")


def stays_from_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Stays at interval level: customer = phone, part = tower, the
    order and ship dates bound the stay (either may come first)."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_shipdate")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_custkey").cast("long").alias("phone"),
        F.col("l_partkey").cast("long").alias("cellid"),
        ts_to_times(F.least("o_orderdate", "l_shipdate")).alias("enter_time"),
        ts_to_times(F.greatest("o_orderdate", "l_shipdate")).alias("exit_time"),
    ).where(F.col("enter_time").isNotNull() & F.col("exit_time").isNotNull())


def subjects_from_customers(customer: DataFrame, min_balance: float = CUSTOMER_MIN_BALANCE) -> DataFrame:
    return (customer.where(F.col("c_acctbal") >= F.lit(min_balance))
            .select(F.col("c_custkey").cast("long").alias("phone")).distinct())
