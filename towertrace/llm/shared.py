"""Helpers the operators share: table access and written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its
    own; a cluster session without it is an error, since a driver-local
    folder would not be seen by the executors.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="towertrace-shared-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder.rstrip("/")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores until no column of `df` is called so."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back.

    Later steps then depend on files every executor sees, not on shuffle
    files of an executor that may be lost.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the files behind a frame made by `cut` that no later step reads."""
    spark = df.sparkSession
    root = shared_folder(spark)
    jvm = spark._jvm
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if root.split(":", 1)[-1].lstrip("/") in folder:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
