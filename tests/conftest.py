from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidemill-test-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from tidemill import prepare_session

    prepare_session(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from tidemill.session import scratch_path

    return lambda name: scratch_path(spark, name)
