import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from crawlframe.session import configure

    builder = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false")
    session = configure(builder.config("spark.ui.showConsoleProgress", "false"), 8).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="crawlframe-test-"))
    return session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
