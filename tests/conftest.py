import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("diagarc-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="diagarc-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from diagarc.plans.shared import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet")


@pytest.fixture(scope="session")
def event_docs(spark, events):
    from diagarc.plans.capture import capture_events

    return capture_events(events, max_samples=20).cache()
