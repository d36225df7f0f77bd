"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "towertrace", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests.

    On a cluster the session comes from ``spark-submit`` and this function
    is not used; the library only reads settings from whatever session it
    is handed.
    """
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master  # executors of `local-cluster` have folders of their own
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder of the session.

    The folder is read from ``spark.checkpoint.dir``.  Only when it is
    unset *and* the session is local (tests, laptops) is a private folder
    created; on a cluster an unset folder yields ``None`` and callers fall
    back to recomputation instead of writing to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not _is_local(spark):
            return None
        conf = tempfile.mkdtemp(prefix="towertrace-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, conf)
    sc.setCheckpointDir(conf)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder for written
    intermediates (text round trips, materialised tables)."""
    root = ensure_checkpoint_dir(spark)
    if root is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; written intermediates need a shared folder")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh catalog name."""
    return f"{name}_{uuid.uuid4().hex}"
