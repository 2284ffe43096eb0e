from __future__ import annotations

import sys
import tempfile
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from logpulse.session import tune

    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("logpulse-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={folder}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session, streaming=True)
    session.stop()


@pytest.fixture
def folder(spark):
    from logpulse.session import scratch_dir

    return scratch_dir(spark, f"test-{uuid.uuid4().hex[:6]}")
