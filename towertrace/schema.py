"""Schemas and fixed codes of the data model."""

from pyspark.sql import types as T

# Event codes of the event table (1 = enter, 2 = exit; any
# other value is neither but still counts as a row between two others).
ENTER = 1
EXIT = 2

# Fixed value: last second of a day.
LAST_SECOND_OF_DAY = 86399

# Event table, in file column order.
EVENT_SCHEMA = T.StructType([
    T.StructField("cellid", T.LongType()),
    T.StructField("times", T.LongType()),
    T.StructField("register", T.IntegerType()),
    T.StructField("phone", T.LongType()),
])

SUBJECT_SCHEMA = T.StructType([T.StructField("phone", T.LongType())])

STAY_COLUMNS = ["phone", "cellid", "enter_time", "exit_time"]

# Default time-bucket width for splitting one (phone, tower) key or one
# tower into independently sorted pieces.  `times` is `yyyyMMddHHmmss`, so
# `times div 1000000` is the day.  Any positive width gives the same
# result; it only bounds how much of a hot key one task sorts.
DAY_BUCKET = 1_000_000
