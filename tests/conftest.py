import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline.session import configure  # noqa: E402

DATA = os.environ.get("SHELFLINE_DATA", "/root/testdata")


# Columns can only be built with a session, and the test modules build some at import.
SESSION = (
    SparkSession.builder.master("local[8]")
    .appName("shelfline-tests")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "8g")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield configure(SESSION)
    SESSION.stop()


@pytest.fixture
def cells(spark):
    """Evaluate one column expression over literal strings."""

    def run(values, build, schema="value string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
        return [r["out"] for r in rows.select("i", build.alias("out")).orderBy("i").collect()]

    return run
