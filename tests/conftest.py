import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def lines(spark):
    """Hand-written lines as a frame with one ``value`` column."""

    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return make


@pytest.fixture()
def write(tmp_path):
    """A text file with the given content; returns its path."""

    def make(name, content):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode("utf-8"))
        return str(path)

    return make


@pytest.fixture()
def read_out():
    """The content of an output folder, its part files in order."""

    def read(path):
        parts = sorted(name for name in os.listdir(path) if name.startswith("part-"))
        texts = []
        for name in parts:
            with open(os.path.join(path, name), encoding="utf-8", newline="") as part:
                texts.append(part.read())
        return "".join(texts)

    return read


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
