import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagetally.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over a one-column frame ``x``, in input order."""
    def run(values, kind, expression):
        frame = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        rows = frame.select("i", expression.alias("y")).collect()
        return [row.y for row in sorted(rows, key=lambda row: row.i)]
    return run
