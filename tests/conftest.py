import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("twinsieve-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA
