"""Table and text sinks.

Sorted text output is written as range-partitioned part files whose
concatenation in name order is sorted (what `cat part-*` gives).  A single
file is made by joining the finished parts through the file system, so the
sort and the writing stay parallel.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COPY_BUFFER = 4 << 20
CONCAT = "fs.capability.paths.concat"


# --- tables ------------------------------------------------------------------

def _beside(name: str, what: str) -> str:
    return f"{name}__{what}_{uuid.uuid4().hex}"


def recover_table(spark: SparkSession, name: str) -> bool:
    """Put the old rows of a table back under its name if a job ended between
    the two renames of `write_table`.  Whether there was something to do."""
    if spark.catalog.tableExists(name):
        return False
    database, _, base = name.rpartition(".")
    if database and not spark.catalog.databaseExists(database):
        return False
    mark = f"{base}__replaced_".lower()
    held = sorted(t.name for t in spark.catalog.listTables(database or None) if t.name.lower().startswith(mark))
    if not held:
        return False
    spark.sql(f"ALTER TABLE {database + '.' if database else ''}{held[-1]} RENAME TO {name}")
    return True


def write_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Replace a catalog table's rows (or create it) as a whole.

    The rows are written under a name of their own and swapped in by two
    renames of the catalog, the old table being dropped last.  A write that
    fails leaves the old rows readable, and a table can be replaced by rows
    read from itself.  If the job is lost between the renames, the old rows
    are kept under `name__replaced_...`, and the next write, or
    `recover_table`, puts them back."""
    spark = df.sparkSession
    recover_table(spark, name)
    staged, old = _beside(name, "staged"), _beside(name, "replaced")
    try:
        df.write.format(fmt).saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    held = spark.catalog.tableExists(name)
    if held:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if held:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if held:
        spark.sql(f"DROP TABLE {old}")


# --- text ----------------------------------------------------------------------

def merge_parts(spark: SparkSession, folder: str, target: str) -> str:
    """Join the part files of `folder` in name order into the file `target`,
    byte for byte what `cat part-*` gives; the parts are used up.

    Where the file system can join files (`concat`), no byte is moved.
    Elsewhere they are copied stream to stream through one buffer of the
    driver's JVM: a file written by one writer has no faster way there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    source, out = path(folder), path(target)
    fs = source.getFileSystem(conf)
    names = sorted(f.getPath().getName() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    parts = [path(source, n) for n in names]
    filled = [p for p in parts if fs.getFileStatus(p).getLen()]
    # joined inside the folder: file systems join files of one folder only
    staged = path(source, f".merged-{uuid.uuid4().hex}")
    if filled and fs.hasPathCapability(source, CONCAT):
        fs.rename(filled[0], staged)
        rest = spark.sparkContext._gateway.new_array(path, len(filled) - 1)
        for i, p in enumerate(filled[1:]):
            rest[i] = p
        if len(filled) > 1:
            fs.concat(staged, rest)
    else:
        stream = fs.create(staged, True)
        try:
            for p in filled:
                part = fs.open(p)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, stream, COPY_BUFFER, False)
                finally:
                    part.close()
        finally:
            stream.close()
    fs.mkdirs(out.getParent())
    fs.delete(out, False)
    fs.rename(staged, out)
    fs.delete(source, True)
    return target


def write_lines(lines: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a one-column frame of strings as text, one value per line.
    Row order inside each part file is the frame's partition order.  With
    `single_file` the folder holds one file, joined from the parts."""
    col = lines.columns[0]
    out = lines.select(F.col(col).cast("string").alias("value"))
    if not single_file:
        out.write.mode("overwrite").text(path)
        return path
    spark = lines.sparkSession
    base = path.rstrip("/")
    parts, whole = f"{base}.parts-{uuid.uuid4().hex}", f"{base}.whole-{uuid.uuid4().hex}"
    out.write.text(parts)
    merge_parts(spark, parts, f"{whole}/part-00000.txt")
    at, held = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (base, whole))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at, True)
    fs.rename(held, at)
    return path


def write_sorted_phones(df: DataFrame, path: str, single_file: bool = False,
                        col: str = "phone", order_by: list[str] | None = None) -> str:
    """Ascending phone list: range-partitioned sort, then text."""
    keys = order_by or [col]
    return write_lines(df.orderBy(*keys).select(F.col(col).cast("string")), path, single_file)
