import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("pagemill-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate one column for a list of rows, in order."""
    from pyspark.sql import functions as F

    def run(rows, names, expression):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        frame = spark.createDataFrame(numbered, ["row_no", *names])
        return [r["out"] for r in frame.select("row_no", expression.alias("out")).orderBy(F.col("row_no")).collect()]
    return run
