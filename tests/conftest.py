from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def partitions(spark):
    """Run a function under several shuffle partition counts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def run(fn, counts=(1, 4, 50)):
        out = []
        for n in counts:
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out.append(fn())
        return out

    yield run
    spark.conf.set("spark.sql.shuffle.partitions", before)
