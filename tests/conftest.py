import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from estate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def values(spark):
    """Evaluate a column expression over single-column inputs: values(fn, [a, b]) -> results."""

    def run(expression, inputs, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
        return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
