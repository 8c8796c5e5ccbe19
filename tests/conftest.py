import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def json_rows(spark):
    """DataFrame of JSON lines from Python objects (strings are taken as lines)."""

    def make(*rows):
        lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows]
        return spark.createDataFrame(list(enumerate(lines)), "row_id bigint, value string")

    return make
