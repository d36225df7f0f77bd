"""Header-less delimited text with a declared schema (never inferred)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.scan import exclusive_scan
from ..schema import EVENT_SCHEMA, SUBJECT_SCHEMA


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with every field set, rows with a null field).

    Spark's permissive CSV reader turns a bad, blank-padded, missing or
    over-long number into null; the pairing rules need every field, so
    such rows go to a quarantine frame instead of failing the job.
    """
    ok = None
    for c in df.columns:
        cond = F.col(c).isNotNull()
        ok = cond if ok is None else ok & cond
    return df.where(ok), df.where(~ok)


def read_events_text(spark: SparkSession, path: str, sep: str = ",",
                     with_quarantine: bool = False):
    """`cellid,times,register,phone` lines."""
    df = spark.read.csv(path, schema=EVENT_SCHEMA, sep=sep, header=False, mode="PERMISSIVE")
    good, bad = split_valid(df)
    return (good, bad) if with_quarantine else good


def read_subjects_text(spark: SparkSession, path: str, with_quarantine: bool = False):
    """One phone per line."""
    df = spark.read.csv(path, schema=SUBJECT_SCHEMA, header=False, mode="PERMISSIVE")
    good, bad = split_valid(df)
    return (good, bad) if with_quarantine else good


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines plus their position key: (file, block start, row in split)."""
    return (
        spark.read.text(path)
        .select(
            F.col("value"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_mid"),
        )
    )


#: The start of a file's address, which Spark writes with one slash or more.
SCHEME = "^([^:/]+):/+"


def _ranked(files: DataFrame, names: list[str]) -> DataFrame:
    """`files (_file, ...)` with `_rank`, the place of the file among `names`
    in order.  The names are the listing the scan itself has made: no job."""
    names = sorted(re.sub(SCHEME, r"\1:/", n) for n in names)
    listed = files.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "_name string, _rank bigint")
    return (files.join(listed, F.regexp_replace("_file", SCHEME, "$1:/") == F.col("_name"), "left").drop("_name")
            .withColumn("_rank", F.expr("coalesce(_rank, CAST(raise_error(concat('not listed: ', _file)) AS BIGINT))")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their split (numbered in order), their file and their
    1-based number in the concatenation of all files of `path` in file-name
    order (what `cat part-*` produces): `(split, line_no, line)`.

    No window spans all lines or all splits: lines are numbered inside their
    split (bounded by the split size), a split's offset inside its file is a
    window over the file's splits, and the files' offsets are a prefix sum
    by file name (`exclusive_scan`).
    """
    return _numbered(spark, path).select("split", "line_no", "line")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """`numbered_lines` with `file` and `file_line`, the number in the file."""
    lines = read_lines(spark, path)
    blocks = lines.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first_mid"))
    w = Window.partitionBy("_file").orderBy("_block")
    blocks = blocks.select(
        "*", F.row_number().over(w).alias("_nth"),
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    files = _ranked(blocks.groupBy("_file").agg(F.sum("_n").alias("_lines"), F.count(F.lit(1)).alias("_splits")),
                    lines.inputFiles())
    before = exclusive_scan(files, "_rank", _lines="sum", _splits="sum")
    files = files.join(before, "_rank").selectExpr(
        "_file AS _f", "coalesce(before__lines, 0) AS _lines_before", "coalesce(before__splits, 0) AS _splits_before")
    blocks = blocks.join(files, F.col("_file") == F.col("_f")).selectExpr(
        "_file", "_block", "CAST(_splits_before + _nth AS INT) AS split", "_lines_before", "_offset", "_first_mid")
    return (
        lines.join(blocks, ["_file", "_block"])
        .withColumn("file_line", F.col("_offset") + F.col("_mid") - F.col("_first_mid") + 1)
        .select("split", (F.col("_lines_before") + F.col("file_line")).alias("line_no"),
                F.col("value").alias("line"), F.col("_file").alias("file"), "file_line")
    )


def read_checked_text(spark: SparkSession, path: str, schema=EVENT_SCHEMA,
                      sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of header-less delimited text.

    A line is bad when the reader cannot take it as it stands: it is blank,
    has too few or too many fields, or a field that is empty or no value of
    its type.  Bad lines come with their text and place: `(file, file_line,
    line_no, line)`.  Every line is in exactly one of the two frames."""
    corrupt = "_corrupt_line"
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), f"`{corrupt}` string"])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_csv("line", ddl, options)
    fine = f"_row IS NOT NULL AND _row.`{corrupt}` IS NULL"
    for f in schema.fields:
        fine += f" AND _row.`{f.name}` IS NOT NULL"
    good = read_lines(spark, path).select(F.from_csv("value", ddl, options).alias("_row")).where(fine)
    bad = _numbered(spark, path).withColumn("_row", parsed).where(f"NOT ({fine})")
    return (good.select(*(F.col(f"_row.`{f.name}`") for f in schema.fields)),
            bad.select("file", "file_line", "line_no", "line"))
