import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakeshift.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="run-")
    session = local_session(
        "tests",
        "4",
        spark__sql__warehouse__dir=f"{work}/warehouse",
        spark__checkpoint__dir=f"{work}/shared",
        spark__sql__shuffle__partitions="4",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def work(tmp_path_factory):
    return str(tmp_path_factory.mktemp("work"))


@pytest.fixture
def column(spark):
    """Evaluate a column expression over text values."""
    from pyspark.sql import functions as F

    def run(expr, values, type_="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
        return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]

    return run
