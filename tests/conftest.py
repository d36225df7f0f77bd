import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="tt-test-ckpt-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("towertrace-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tt-test-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from towertrace.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
