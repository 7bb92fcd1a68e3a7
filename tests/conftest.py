import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over a one-column frame."""

    def apply(values, kind, expression):
        from pyspark.sql import functions as F

        rows = [(place, value) for place, value in enumerate(values)]
        frame = spark.createDataFrame(rows, f"place int, x {kind}")
        result = frame.select("place", expression(F.col("x")).alias("y"))
        return [row["y"] for row in result.orderBy("place").collect()]

    return apply
