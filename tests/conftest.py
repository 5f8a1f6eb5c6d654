import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def mini(spark):
    """Six respondents whose results can be worked out by hand."""
    rows = [
        ("1", 10, 2, 18, 1, 1.0, 1, 1, 1), ("2", 10, 2, 30, 4, 3.0, 0, 0, 0), ("3", 10, 1, 24, 2, 2.0, 1, 1, None),
        ("4", 9, 2, 40, 6, 1.0, None, None, None), ("5", 9, 1, 20, 2, 1.0, 1, 1, 1), ("6", 9, 1, 45, 7, 2.0, 0, 0, 0),
    ]
    return spark.createDataFrame(
        rows, "caseid string, v024 int, v025 int, v012 int, v013 int, v005 double, v169a int, owns_mobile_phone int, currently_working int"
    ).cache()
