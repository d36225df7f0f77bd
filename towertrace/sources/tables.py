"""Catalog tables: the Hive-style managed and external tables of the
reference, expressed with Spark's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import EVENT_SCHEMA
from ..sinks.text import write_table
from .text import split_valid


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def _same_place(a: str, b: str) -> bool:
    bare = lambda x: x.split(":", 1)[-1].rstrip("/").replace("//", "/")
    return bare(a) == bare(b)


def register_external_text_table(spark: SparkSession, name: str, location: str,
                                 schema=EVENT_SCHEMA, sep: str = ",", replace: bool = False,
                                 with_quarantine: bool = False):
    """`create external table ... row format delimited ... location`: a
    catalog table over a directory of delimited part files.

    A table of that name over another place or with other columns is an
    error, or is registered anew with `replace` (its files stay).  Returns
    the rows with every field set, and with `with_quarantine` the others."""
    if spark.catalog.tableExists(name):
        held = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
        same = held and _same_place(held["data_type"], location) and [
            (f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
        if not same and not replace:
            raise ValueError(f"table {name} exists with another location or other columns")
        if not same:
            spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING csv "
        f"OPTIONS (sep '{sep}', header 'false', mode 'PERMISSIVE') LOCATION '{location}'"
    )
    good, bad = split_valid(spark.table(name))
    return (good, bad) if with_quarantine else good


def load_managed_table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """`LOAD DATA ... OVERWRITE INTO TABLE`: replace a managed table's rows."""
    write_table(df, name)
    return spark.table(name)


def ensure_database(spark: SparkSession, name: str) -> None:
    """`create database` without dropping anything that exists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """`show tables` (names only; catalog metadata, not data)."""
    return sorted(t.name for t in spark.catalog.listTables(database))
