import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent
# The workers import the package and the test modules from here.
PATHS = [str(HERE.parent), str(HERE)]
sys.path[:0] = PATHS
os.environ["PYTHONPATH"] = os.pathsep.join([*PATHS, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("talkatlas-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="talkatlas-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
