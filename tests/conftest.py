import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from factgrade.session import local_session  # noqa: E402

TESTDATA = os.environ.get("FACTGRADE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests", memory="8g", checkpoints=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("shared tables are not available")
    return path


@pytest.fixture
def evaluate(spark):
    """Evaluate an expression over one row per value."""

    def run(expression, values, schema="x string"):
        rows = [v if isinstance(v, tuple) else (v,) for v in values]
        df = spark.createDataFrame(rows, schema).coalesce(1)
        return [r[0] for r in df.select(expression.alias("out")).collect()]

    return run
