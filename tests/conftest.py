from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from partatlas.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]", "partatlas-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Small DataFrame from a DDL schema and rows."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def values(spark):
    """Value of an expression for each of some strings."""

    def run(expression, *inputs):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
        return [r.o for r in rows.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
