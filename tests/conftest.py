import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column expression over a list of values of column ``c``."""

    def evaluate(values, expression, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        rows = df.select("i", expression.alias("out")).collect()
        return [r.out for r in sorted(rows, key=lambda r: r.i)]

    return evaluate


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
