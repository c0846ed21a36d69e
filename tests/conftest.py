import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from papersieve.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Values of a Column function over a list of strings."""
    from pyspark.sql import functions as F

    def run(function, values):
        frame = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        rows = frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
        return [r["out"] for r in rows]

    return run
