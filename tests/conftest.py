import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[4]", **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(shared / "work"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows from a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def value(spark):
    """Evaluate expressions on a single row."""
    def run(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)
    return run
